"""Training-data operators: one module each, plus the queries that register them."""
