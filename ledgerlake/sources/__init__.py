"""ledgerlake.sources."""
