"""The pipeline's stages, each a function from DataFrames to DataFrames."""
