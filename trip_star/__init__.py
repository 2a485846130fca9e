"""trip_star: a trip star-schema engine on Spark DataFrames.

Reads raw trips and a zone lookup, builds ten dimensions with deterministic
first-seen ids, attaches them to a fact with null-safe joins, writes the star
as full-refresh tables and answers reports and quality checks on it.
"""

__version__ = "0.1.0"
