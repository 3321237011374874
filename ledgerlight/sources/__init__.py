"""Reading and writing tables, and flattening landed documents."""
