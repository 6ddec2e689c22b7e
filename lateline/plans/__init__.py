"""Plans: the end-to-end pipeline and the registry of named queries."""
