"""Reading and writing versioned, partitioned tables."""
