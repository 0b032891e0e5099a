"""radiospark: a PySpark-native analytics engine for radio-interferometry tables."""
