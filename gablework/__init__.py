"""Tabular preparation and regression model selection as Spark jobs."""
