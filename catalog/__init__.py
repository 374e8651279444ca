"""Registered queries over the shared Parquet tables, and the SQL that states their results."""
