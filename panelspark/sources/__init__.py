"""Reading, landing and idempotent writing of tables."""
