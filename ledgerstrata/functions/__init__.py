"""Column-level helpers: rules and scalar expressions."""
