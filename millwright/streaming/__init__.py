"""Incremental loading: what is new in a source, and landed files consumed once."""
