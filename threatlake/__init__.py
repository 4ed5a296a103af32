"""Threat-report analytics and training-data operators on PySpark."""
