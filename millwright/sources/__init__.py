"""Reading plants, keyed tables and lists; writing files and partitioned tables."""
