"""Product-catalogue analytics as Spark DataFrames, streams and ML stages."""
