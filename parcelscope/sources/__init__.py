"""Where rows come from and where they go: CSV extracts, lake tables, stand-in tables."""
