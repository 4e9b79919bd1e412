"""Column expressions: text, time, category, geo, price, identity."""
