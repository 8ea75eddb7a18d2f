"""Reading rasters and tables, and writing stacks, tables and feature files."""
