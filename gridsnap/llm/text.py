"""Folding of words, shared by the operators of this subpackage."""

from __future__ import annotations

import unicodedata

# Letters that do not decompose into a base letter and a mark.
LETTERS = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ı": "i", "þ": "th"}


def fold(text: str) -> str:
    """Lower case without accents."""
    text = text.lower()
    if text.isascii():
        return text
    text = "".join(LETTERS.get(c, c) for c in text)
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
