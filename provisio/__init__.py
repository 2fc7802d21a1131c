"""Provisio: retail credit-risk analytics as PySpark DataFrame operators."""
