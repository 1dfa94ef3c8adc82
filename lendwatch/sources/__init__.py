"""Reading, parsing and writing of files."""
