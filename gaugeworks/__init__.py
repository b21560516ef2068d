"""Station-telemetry analytics expressed as Spark DataFrames."""
