"""The star schema and the queries over it, as lazy plans."""
