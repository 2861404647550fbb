"""Fleet sensor health analytics expressed with Spark DataFrames."""
