"""Reading and writing of raw files, tables and file metadata."""
