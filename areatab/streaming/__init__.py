"""areatab.streaming."""
