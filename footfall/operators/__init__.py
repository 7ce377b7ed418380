"""Cleaning, metrics, validation, quality, warehouse and report operators."""
