"""The star schema, the reports on it, and the jobs that run them."""
