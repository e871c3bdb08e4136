"""Spark-native operators, sources, sinks and jobs for tabular analytics."""
