"""Column-level building blocks (no shuffles happen here)."""
