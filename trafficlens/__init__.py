"""trafficlens: web-traffic reporting operators on PySpark DataFrames."""
