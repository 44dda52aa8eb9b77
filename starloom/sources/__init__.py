"""Reading raw files and writing and reading the warehouse."""
