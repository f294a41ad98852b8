"""Daily treasury cash reconciliation as set-at-a-time Spark plans."""
