"""Operators for preparing training text at scale; each module documents its edge cases."""
