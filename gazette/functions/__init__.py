"""Column functions: each takes and returns ``pyspark.sql.Column`` objects."""
