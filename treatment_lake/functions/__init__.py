"""Column expressions: tag unwrap, calendar and clock keys, safe casts."""
