"""Reusable DataFrame-in, DataFrame-out operators."""
