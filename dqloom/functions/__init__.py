"""Column builders: text, names, numbers, types and time windows."""
