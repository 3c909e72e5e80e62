"""Operators for preparing training text at scale, apart from the marketplace library."""
