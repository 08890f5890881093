"""A PySpark-native engine for market observations and master data."""
