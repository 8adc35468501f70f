"""Checks and transforms.  Every function takes DataFrames and returns a lazy DataFrame."""
