"""telarium: curriculum analytics and corpus preparation on Spark DataFrames."""
