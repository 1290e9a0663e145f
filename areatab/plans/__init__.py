"""areatab.plans."""
