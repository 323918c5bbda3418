"""Reading and writing: the day-partitioned tables, CSV files and the run log."""
