"""Readers: tables and change tables over JDBC, documents and change events from files or message logs."""
