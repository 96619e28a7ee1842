"""Quality rules for large collections of nested JSON telemetry reports, on Spark DataFrames."""
