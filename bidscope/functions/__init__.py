"""Column builders: scalar functions that stay inside Catalyst."""
