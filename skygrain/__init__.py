"""Air-quality time-series analytics as Spark DataFrame plans."""
