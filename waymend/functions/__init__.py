"""Column functions: text, numbers, clock times, similarity."""
