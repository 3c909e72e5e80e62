"""Reusable DataFrame -> DataFrame building blocks."""
