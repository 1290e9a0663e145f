"""areatab.operators."""
