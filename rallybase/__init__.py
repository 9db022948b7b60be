"""rallybase: a PySpark-native engine for messy competition records."""
