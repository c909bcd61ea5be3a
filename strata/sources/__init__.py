"""Readers for raw deliveries and their target schemas."""
