"""Raw marketplace tables derived from the given test tables, for queries and tests."""
