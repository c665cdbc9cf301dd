"""Readers: tables, delimited files, file inventory, run history and logs."""
