"""A PySpark-native analytics engine for listing intelligence and training-data preparation."""
