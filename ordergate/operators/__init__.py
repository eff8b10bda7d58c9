"""DataFrame operators: validate, split, merge, summarise."""
