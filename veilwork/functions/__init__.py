"""Column -> Column functions; no UDFs."""
