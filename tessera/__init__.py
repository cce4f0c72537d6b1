"""Spark-native entity matching, scoring and shortlisting engine."""
