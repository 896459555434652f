"""Column expressions: coercion, classes, geometry and scales."""
