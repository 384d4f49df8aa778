"""Season standings as set-based Spark DataFrames.

Raw per-race JSON becomes typed, season-partitioned tables; those become a
star schema of dimensions and per-race facts; measures answer point-in-time
questions over the star.  Everything is built from DataFrame expressions, so
Catalyst plans it and no row passes through Python.
"""
