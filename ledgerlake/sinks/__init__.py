"""ledgerlake.sinks."""
