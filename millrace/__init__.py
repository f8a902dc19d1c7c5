"""A PySpark engine for workforce supply-and-demand data."""
