"""Reading files and tables, and writing results."""
