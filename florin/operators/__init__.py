"""DataFrame operators: date bridge, tagged facts, per-source metrics, keyed merge, transposition."""
