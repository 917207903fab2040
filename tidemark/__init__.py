"""Incremental replication of tables and document collections with Spark DataFrames."""
