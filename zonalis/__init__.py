"""zonalis: a PySpark-native analytics engine for zonal, tabular and evaluation workloads."""
