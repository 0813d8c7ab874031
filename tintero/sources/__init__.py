"""Reading and writing: article files, the warehouse, result files."""
