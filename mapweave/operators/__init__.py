"""DataFrame operators: filters, list joins, keys, reshapes, reports."""
