"""Texts with the edge cases every corpus operator has to take."""

LONG = "stone river cloud " * 3000
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog again and again"),
    (2, "THE quick brown fox jumps over the lazy dog again and again"),
    (3, ""),
    (4, None),
    (5, "   \t\n"),
    (6, "Äpfel und Birnen"),
    (7, "äpfel und Birnen"),
    (8, LONG),
    (9, LONG),
    (9, LONG),
    (10, LONG + "end"),
    (None, "a text whose row has no id"),
    (None, "a text whose row has no id"),
    (11, "one two three"),
    (12, "one two three"),
    (12, "another text under a used id"),
]
