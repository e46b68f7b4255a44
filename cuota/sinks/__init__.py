"""Table, CSV, sheet and manifest writers."""
