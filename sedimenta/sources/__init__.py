"""Readers: JSON, CSV, date-selected files, table slices and SQL text."""
