"""Readers: raw search and viewing logs, dictionaries, benchmark-table adapters."""
