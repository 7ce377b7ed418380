"""Jobs: the daily batch, the warehouse load and the file ingest."""
