"""areatab.functions."""
