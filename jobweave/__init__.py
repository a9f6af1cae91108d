"""jobweave: a job-market data engine written as Spark logical plans."""
