"""Built-in expressions used by the operators."""
