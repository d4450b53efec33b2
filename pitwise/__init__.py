"""pitwise: point-in-time feature building and data quality on Spark DataFrames."""
