"""ordwave: order and competitor-pricing event ingestion and analytics on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark
built-in expressions, so the same code runs in batch and in Structured
Streaming and Catalyst plans the work.
"""

__version__ = "0.1.0"
