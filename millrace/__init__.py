"""Data-engineering operators that take DataFrames and return DataFrames.

The caller owns the session, the paths and the clock: operators start no
session, read no wall clock and run an action only where their docstring says
so.
"""
