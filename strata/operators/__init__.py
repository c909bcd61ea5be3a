"""Relational operators: rules and flags, lookups, dimensions, fact building, marts."""
