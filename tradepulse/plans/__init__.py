"""The warehouse jobs, composed of operators. Batch forms take and give DataFrames."""
