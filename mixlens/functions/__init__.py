"""Column expressions: cleaning, ratios, calendar parts and text masking."""
