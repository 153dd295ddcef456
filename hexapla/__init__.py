"""hexapla: a PySpark-native engine for catalogue-style data."""
