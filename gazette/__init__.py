"""gazette: a Spark-native engine for notice intake, classification and reporting.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; Python runs only inside three Arrow-batched extension points
(text normalisation, the HTML event extractor and the caller's scorer).
"""

__version__ = "0.1.0"
