"""Column builders (pure expressions, all evaluated inside whole-stage codegen)."""
