"""Star-schema building and sales reports as Spark DataFrame jobs."""
