"""Texts that every operator on documents has to stand: null, empty, blanks, ties, long, odd characters."""

ODD = [None, "", " \t\n ", "one", "same text here again and once more", "same text here again and once more",
       "é ß 日本語   x　y", "a " * 30_000, "x" * 50_000, "line\n\nline\n\r\nline", "\x0b\x0c\x1c\x85", "a \0b \0"]
