"""Column-level building blocks; every one is a Catalyst expression, none is a UDF."""
