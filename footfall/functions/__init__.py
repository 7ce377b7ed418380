"""Reusable column expressions and grouping helpers."""
