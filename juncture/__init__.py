"""juncture: a PySpark-native engine for recurrence testing of structural-variant peptides."""
