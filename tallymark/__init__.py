"""Analytics operators, table builders and scoring jobs for multi-domain business data on PySpark."""
