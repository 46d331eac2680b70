"""Feed documents and stored tables as DataFrames."""
