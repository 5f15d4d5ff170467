"""Workforce tenure analytics as PySpark DataFrame operators."""
