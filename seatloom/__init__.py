"""Constituency vote analytics expressed as Spark DataFrame plans."""
