"""keeprule: retention analytics of a message archive, on Spark DataFrames."""
