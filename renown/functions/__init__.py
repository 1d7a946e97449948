"""Column expressions: titles, texts, claims and display fields."""
