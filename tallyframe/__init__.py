"""Rolling statistics, leak-free training matrices and market decisions on Spark DataFrames."""
