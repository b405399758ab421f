"""ledgerlake.operators."""
