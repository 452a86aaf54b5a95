"""Column builders: geometry, scores, text."""
