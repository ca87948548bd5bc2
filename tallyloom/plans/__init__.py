"""Composed jobs: snapshot, preprocessing, model fitting, scoring and the query catalogue."""
