"""The operators bound to the driver's tables, each beside its SQL oracle."""
