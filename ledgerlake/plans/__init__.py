"""ledgerlake.plans."""
