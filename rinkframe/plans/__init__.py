"""User-level dataflows."""
