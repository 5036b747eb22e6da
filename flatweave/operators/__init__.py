"""Profiling and flattening operators on DataFrames."""
