"""A PySpark-native engine for causal time-series analytics on wide sensor data."""
