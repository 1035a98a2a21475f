"""Incremental loading of connection files dropped into a landing folder."""
