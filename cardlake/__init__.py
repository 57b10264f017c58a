"""Card-transaction and loan analytics as Spark DataFrame jobs."""
