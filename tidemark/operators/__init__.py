"""DataFrame operators: dedup, expectations, suites, model tests, history, fault injection, ops."""
