"""Event parsing, nesting and the idempotent stream sink."""
