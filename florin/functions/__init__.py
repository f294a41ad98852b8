"""Column-level building blocks: calendar arithmetic, decimal policy, text parsing."""
