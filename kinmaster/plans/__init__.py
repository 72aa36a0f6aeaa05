"""Ready-made chains of operators and the registered queries."""
