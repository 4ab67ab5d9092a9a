"""linkflow: a PySpark-native engine for incremental web-content analytics."""
