"""PySpark-native analytics engine for utility-network maps."""
