"""Transaction features, risk scoring and reports as Spark DataFrame jobs."""
