"""Marketplace delivery analytics on Spark: bronze, silver, gold, checks and measures."""
