"""Control metadata and whole-source runs."""
