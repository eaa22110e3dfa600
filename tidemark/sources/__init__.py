"""Sources: the given tables and the source-system snapshots derived from them."""
