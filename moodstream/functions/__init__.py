"""Column expressions: text cleaning, JSON payloads, class names and time labels."""
