"""Document analytics on Spark: cleaning, structuring and checking text corpora."""
