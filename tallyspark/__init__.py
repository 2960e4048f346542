"""tallyspark: accounting data-mart jobs expressed as Spark DataFrame plans.

Every job takes DataFrames (or a session plus a path) and returns a DataFrame;
nothing is collected to the driver except bounded control values (a date, a
duplicate-key probe of at most one row).
"""

__all__ = ["session", "schemas"]
