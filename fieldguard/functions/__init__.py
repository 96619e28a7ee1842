"""Column-level building blocks (no data access, no actions)."""
