"""A Spark-first engine for private-markets evidence, holdings and analytics."""
