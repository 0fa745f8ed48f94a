"""Hierarchical retail demand forecasting as ordinary Spark jobs."""
