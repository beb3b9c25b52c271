"""Lay out, check, catalogue and query large tables of map features with Spark DataFrames."""
