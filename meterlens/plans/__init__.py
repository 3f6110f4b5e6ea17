"""The datasets, rollups and reports, each a function from DataFrames to a DataFrame."""
