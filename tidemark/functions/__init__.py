"""Column expressions shared by the plans. None of them is a UDF."""
