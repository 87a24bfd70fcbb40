"""Column builders; no Python UDF among them."""
