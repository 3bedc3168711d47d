"""DataFrame operators: identifiers, connections, statistics, schema inference."""
