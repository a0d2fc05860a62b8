"""The dataflow steps: each takes and returns DataFrames."""
