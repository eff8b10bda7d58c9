"""File discovery, tolerant CSV and JSON readers, and the ledger of processed files."""
