"""plumbwright: data-quality, feature and monitoring operators on Spark DataFrames."""
