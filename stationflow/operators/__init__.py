"""Operators on station data, each a function of DataFrames."""
