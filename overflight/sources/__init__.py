"""Raw snapshot files, the bronze table, reference tables and day-partitioned storage."""
