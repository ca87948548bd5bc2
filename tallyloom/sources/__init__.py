"""Scans, sinks, the prediction log and the model registry."""
