"""Column expressions shared by the operators (V1-V13). All are built-in Spark functions."""
