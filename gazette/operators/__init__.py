"""DataFrame operators: ``DataFrame -> DataFrame`` functions built on Spark SQL."""
