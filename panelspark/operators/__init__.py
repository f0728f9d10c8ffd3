"""Operators on panels, long tables with one row per entity and period."""
