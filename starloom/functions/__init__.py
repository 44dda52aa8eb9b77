"""Column expressions shared by the cleaning steps and the queries."""
