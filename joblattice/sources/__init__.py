"""Readers and writers at the edges: landed API pages, CSV, parquet tables, stored models."""
