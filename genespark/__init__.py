"""Comparative genomics analytics as plain Spark DataFrame operators."""
