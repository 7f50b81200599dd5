"""Readers: raw JSON, streams, mapped CSV, geo ranges, catalog tables, fixtures."""
