"""Sources: the driver's Parquet tables, the staged raw layer, the calendar."""
