"""The medallion layers, the quality suites and the measures."""
