"""DataFrame-to-DataFrame operators. All are lazy and take column names as parameters."""
