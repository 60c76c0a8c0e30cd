"""Genomic-variant table operators written for Spark DataFrames.

Every operator takes and returns DataFrames and stays lazy: readers build frames, operators
describe joins, groupings and windows, and sinks write. See README.md for the module map.
"""

__version__ = "0.1.0"
