"""Reading and writing of record and result files."""
