"""Masking of listed words."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def mask_pattern(words: list[str]) -> str:
    """One alternation for a word list; the shortest word at a position wins.

    A word that begins with another listed word can never win, so it is left out.
    """
    kept: list[str] = []
    for word in sorted({w for w in words if w}, key=lambda w: (len(w), w)):
        if not any(word.startswith(k) for k in kept):
            kept.append(word)
    return "|".join(re.sub(r"([^\w\s])", r"\\\1", w) for w in kept)


def masked(text: Column, words: list[str]) -> Column:
    """Scan left to right and replace each listed word by as many stars as it has characters."""
    pattern = mask_pattern(words)
    if not pattern:
        return text
    between = F.split(text, pattern)
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    stars = F.transform(hits, lambda h: F.repeat(F.lit("*"), F.length(h)))
    return F.array_join(F.zip_with(between, stars, lambda b, s: F.concat(b, F.coalesce(s, F.lit("")))), "")
