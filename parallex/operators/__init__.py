"""DataFrame operators (joins, aggregates, ranks)."""
