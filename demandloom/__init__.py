"""Retail demand and inventory analytics expressed as Spark DataFrame plans."""
