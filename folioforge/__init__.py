"""Analytics over digitised business records, on Spark DataFrames."""
