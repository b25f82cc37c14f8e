"""Card-transaction scoring and monitoring expressed as Spark DataFrame operators."""
