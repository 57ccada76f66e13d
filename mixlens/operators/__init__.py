"""Operators over reports, facts and weekly series; each takes and returns DataFrames."""
