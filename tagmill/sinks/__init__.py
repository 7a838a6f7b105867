"""Where results go; every sink may be run again without changing the outcome."""
