"""DataFrame operators: point-in-time features, table writes, catalog and merge."""
