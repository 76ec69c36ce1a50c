"""Column expressions: exact rounding, text cleaning and business classifications."""
