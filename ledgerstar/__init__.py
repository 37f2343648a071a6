"""Star-schema analytics of bank transactions on Spark DataFrames."""
