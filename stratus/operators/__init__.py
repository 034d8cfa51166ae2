"""DataFrame -> DataFrame operators (flatten, aggregates, latest values, registry)."""
