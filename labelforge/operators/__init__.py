"""DataFrame operators: rules, membership, de-duplication, features, models, metrics."""
