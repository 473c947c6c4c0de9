"""labelloom: merge, split and pair labelled text datasets with Spark DataFrames."""
