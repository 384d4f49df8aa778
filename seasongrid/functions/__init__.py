"""Column functions: built-in expressions with a name."""
