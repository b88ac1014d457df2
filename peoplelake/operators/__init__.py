"""Table-in, table-out operators, one module per layer."""
