"""Operators on DataFrames, for use on their own or through ``df.transform``."""
