"""Operators: plain functions from DataFrame to DataFrame, column names as parameters."""
