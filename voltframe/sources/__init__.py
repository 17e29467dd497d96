"""Inputs and tables: landing readers, fixture views over the driver
tables, and parquet tables with partition-level upsert."""
