"""Event flattening on PySpark: nested web-analytics exports to flat analysis tables."""
