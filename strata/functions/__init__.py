"""Column-level functions; every one is a Catalyst expression."""
