"""lodestack: a PySpark-native engine for large collections of case files."""
