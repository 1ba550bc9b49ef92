"""Operators: DataFrame to DataFrame, nothing collected."""
