"""Column builders: expressions over columns, no shuffles."""
