"""Analytics over job postings on Spark."""
