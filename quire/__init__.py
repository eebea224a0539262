"""quire: paragraph-level text analytics on Spark DataFrames."""
