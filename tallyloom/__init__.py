"""Tabular scoring, evaluation and monitoring as Spark DataFrame operators."""
