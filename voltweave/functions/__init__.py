"""Column functions: geometry, coordinate systems, names and values."""
