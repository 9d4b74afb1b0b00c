"""Log-delivery analytics expressed as Spark DataFrame operators."""
