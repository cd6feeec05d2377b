"""A PySpark-native engine that builds a queryable catalogue of happenings from captured public text."""
