"""Queries over the supplied tables, one per operator, and their SQL twins."""
