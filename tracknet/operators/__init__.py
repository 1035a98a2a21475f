"""Graph operators: model building, lookups, aggregates, paths, scores."""
