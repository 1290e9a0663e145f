"""areatab.sources."""
