"""DataFrame operators: joins, aggregates, windows, top-k, history, quality."""
