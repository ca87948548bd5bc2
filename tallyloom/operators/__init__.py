"""DataFrame operators: contracts, profiling, splits, metrics, drift, quotas."""
