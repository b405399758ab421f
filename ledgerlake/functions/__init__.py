"""ledgerlake.functions."""
