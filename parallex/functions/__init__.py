"""Column-level functions (no shuffles): text, arrays, scores."""
