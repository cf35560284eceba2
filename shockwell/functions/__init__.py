"""Column builders: expressions only, no actions and no Python UDFs."""
