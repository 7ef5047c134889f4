"""Operators on cubes, code lists and rule tables: DataFrames in, a DataFrame out."""
