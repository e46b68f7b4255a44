"""Readers: tidy CSV tables, workbooks, HTML pages and file listings."""
