"""PySpark-native quote verification and evidence coding."""
