"""Named queries: each binds operators to the driver tables, next to equivalent SQL."""
