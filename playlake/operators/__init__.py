"""DataFrame operators. Inputs and outputs are DataFrames."""
