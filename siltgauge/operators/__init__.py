"""DataFrame operators: synthesis, injection, validation, table checks, metrics."""
