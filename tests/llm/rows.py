"""Documents that are hard to handle."""

#: Nulls in every column, empty, blank and long texts, ties, repeated rows.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, "the  quick brown\tfox jumps over the lazy dog near the river bank", "en", None),
    (7, "The quick brown fox jumps over the lazy dog near the river bank", None, "a"),
    (7, "The quick brown fox jumps over the lazy dog near the river bank", None, "a"),
    (3, None, "en", "b"), (4, "", "fr", "b"), (5, " \n\t ", None, None),
    (None, "un texte sans nom mais avec des mots", "fr", "c"), (6, "12 34 !!", "fr", "c"),
    (8, "mot " * 30000, "fr", "d"), (9, "x", "en", "d"), (10, "é𠀀 <|endoftext|> 'll\n\nI've", "en", "d"),
    (9, "another text under the same id", "en", "e"), (11, "a" * 5000, None, "e"),
]
