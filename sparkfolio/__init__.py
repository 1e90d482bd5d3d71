"""Sparkfolio: event-record analytics as lazy PySpark DataFrame transformations."""
