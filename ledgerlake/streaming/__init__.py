"""ledgerlake.streaming."""
