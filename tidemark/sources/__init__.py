"""Readers and writers: tables, seeds, fixtures, drift-tolerant JSON, by-name loads, exports."""
