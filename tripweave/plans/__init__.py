"""Jobs composed of operators."""
