"""Business-record analytics as Spark DataFrame plans."""
