"""Public-integrity analytics as Spark DataFrame operators."""
