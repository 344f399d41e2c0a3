"""Dataflow operators: each takes and returns DataFrames."""
