"""Ready-made queries over the test tables, with their SQL counterparts."""
