"""Declarative web-page and text-corpus processing on Spark."""
