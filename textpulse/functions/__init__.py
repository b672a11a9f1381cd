"""Column functions: pure expressions, no actions, no UDFs."""
