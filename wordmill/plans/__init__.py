"""Plan-level helpers and the query catalog over the driver tables."""
