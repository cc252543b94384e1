"""Column expressions and small reusable DataFrame building blocks."""
