"""Plain Python versions that the operators are held against."""

import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or "")


def space_words(text):
    return SPACE_WORD.findall(text or "")


def alnum_words(text):
    return ALNUM_WORD.findall(lower(text))


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def odd_documents():
    """Nulls in every column, empty and very long texts, repeated rows and ties."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
    rows = [
        (1, "", "en", "a", 0),
        (2, None, None, None, None),
        (3, "one two three", "en", "a", 13),
        (3, "one two three", "en", "a", 13),
        (None, "a null id here", "en", "b", 3),
        (4, long, "en", "b", len(long)),
        (5, long, "en", "a", len(long)),
        (6, "x", None, "", 1),
        (7, " \t\n ", "fr", "a", 4),
        (8, "été Straße \u0085 ÀÉ 東京 😀 end", "fr", None, 5),
    ]
    return rows
