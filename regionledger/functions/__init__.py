"""Column expressions: codes, numbers, ratios, notes and pass flags."""
