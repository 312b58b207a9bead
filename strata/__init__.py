"""strata: a PySpark-native medallion engine for trip records."""
