"""ordermill: order analytics on Spark.

Batch marts (a star schema of customers, products, sellers and orders),
a Structured Streaming ingest into a landing table, live dashboard metrics
over it, and a data-quality suite. Every operator maps DataFrames to
DataFrames with built-in Spark operators; only small, bounded check
results ever reach the driver.
"""

__version__ = "0.1.0"
