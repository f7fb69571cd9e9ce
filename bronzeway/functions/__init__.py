"""Column to Column functions; everything here stays in built-in expressions."""
