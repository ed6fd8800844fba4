"""Operators over people, works, identities and observations."""
