"""millrace: analytics operators and cost/shop data products as Spark jobs."""
