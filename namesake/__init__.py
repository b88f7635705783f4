"""Record linkage and entity resolution on Spark DataFrames."""
