"""Table-change, reconciliation and control operators. Each takes and returns DataFrames."""
