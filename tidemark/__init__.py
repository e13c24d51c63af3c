"""A PySpark-native engine for change-data analytics over semi-structured sources."""
