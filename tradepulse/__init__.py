"""tradepulse: a layered real-time commerce warehouse on Spark DataFrames."""
