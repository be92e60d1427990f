"""Text as Column expressions: words, pieces, windows. Everything stays inside one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

GAP = "[ \t\n\r\f]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case words between blanks."""
    return F.filter(F.split(F.lower(text), GAP), lambda w: w != "")


def glyphs(text: Column) -> Column:
    """Lower-case characters without white space."""
    return F.filter(F.split(packed(text), ""), lambda c: c != "")


def packed(text: Column) -> Column:
    """Lower-case text without white space."""
    return F.regexp_replace(F.lower(text), GAP, "")


def cjk_words(text: Column) -> Column:
    """Words for text that mixes Chinese with other scripts.

    A run of Chinese characters gives its single characters and its character pairs; other
    runs give their blank-separated words.
    """
    run = "[一-鿿]+|[^ \t\n\r\f一-鿿]+"
    runs = F.regexp_extract_all(F.lower(text), F.lit(f"({run})"), 1)

    def parts(r: Column) -> Column:
        n = F.length(r)
        singles = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(r, i, F.lit(1)))
        pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(r, i, F.lit(2)))
        chinese = F.when(n > 1, F.concat(singles, pairs)).otherwise(singles)
        return F.when(r.rlike("^[一-鿿]"), chinese).otherwise(F.array(r))

    return F.flatten(F.transform(runs, parts))


def pieces(text: Column, delimiter: str) -> Column:
    """Non-empty parts between a literal delimiter."""
    return F.filter(F.split(text, f"\\Q{delimiter}\\E"), lambda p: p != "")


def pieces_by_pattern(text: Column, pattern: str) -> Column:
    """Non-empty trimmed parts between matches of a pattern."""
    parts = F.transform(F.split(text, pattern), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def windows(text: Column, size: int, overlap: int, unit: str = "char") -> Column:
    """Fixed-size chunks; a new one starts every ``size - overlap`` characters or words."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    if unit == "word":
        def cut(items: Column) -> Column:
            starts = F.sequence(F.lit(0), F.size(items) - 1, F.lit(step))
            chunks = F.transform(starts, lambda i: F.array_join(F.slice(items, i + 1, F.lit(size)), " "))
            return F.when(F.size(items) > 0, chunks).otherwise(F.array().cast("array<string>"))

        return let(words(text), cut)
    n = F.length(text)
    chunks = F.transform(F.sequence(F.lit(0), n - 1, F.lit(step)), lambda i: F.substring(text, i + 1, F.lit(size)))
    return F.when(n > 0, chunks).otherwise(F.array().cast("array<string>"))


def nested_pieces(text: Column, delimiters: list[str], size: int) -> Column:
    """Split by the first delimiter; parts above ``size`` characters by the next, and so on."""
    parts = pieces(text, delimiters[0])
    for delimiter in delimiters[1:]:
        parts = F.flatten(F.transform(parts, _resplit(delimiter, size)))
    return parts


def _resplit(delimiter: str, size: int) -> Callable[[Column], Column]:
    return lambda p: F.when(F.length(p) > size, pieces(p, delimiter)).otherwise(F.array(p))


def joined_runs(items: Column, starts: Column, separator: str) -> Column:
    """Join neighbouring items; ``starts`` lists the 0-based positions where a run begins."""
    return F.transform(runs(items, starts), lambda run: F.array_join(run, separator))


def runs(items: Column, starts: Column) -> Column:
    """Cut an array into the runs that begin at the 0-based ``starts``."""
    def cut(pair: Column) -> Column:
        i, s = pair["items"], pair["starts"]
        return F.transform(s, lambda start, no: F.slice(
            i, start + 1, F.coalesce(F.get(s, no + 1), F.size(i)) - start))

    return let(F.struct(items.alias("items"), starts.alias("starts")), cut)


def positions(items: Column) -> Column:
    """0-based positions of an array; an empty array has none."""
    empty = F.array().cast("array<int>")
    return F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1)).otherwise(empty)


def word_cosine(a: Column, b: Column) -> Column:
    """Cosine of the 0/1 word vectors of two texts."""
    return set_cosine(F.array_distinct(words(a)), F.array_distinct(words(b)))


def word_counts(items: Column) -> Column:
    """``array<struct<term, tf>>``: sorted words by their runs, so counting needs no shuffle."""
    def count(p: Column) -> Column:
        return F.transform(p["starts"], lambda s, i: F.struct(
            F.get(p["sorted"], s).alias("term"),
            (F.coalesce(F.get(p["starts"], i + 1), F.size(p["sorted"])) - s).cast("bigint").alias("tf")))

    def mark(words_: Column) -> Column:
        starts = F.filter(positions(words_), lambda i: (i == 0) | (F.get(words_, i) != F.get(words_, i - 1)))
        return let(F.struct(words_.alias("sorted"), starts.alias("starts")), count)

    return let(F.sort_array(items), mark)


def set_cosine(a: Column, b: Column) -> Column:
    """Cosine of the 0/1 vectors of two arrays without duplicates."""
    def cosine(p: Column) -> Column:
        norm = F.sqrt(F.size(p["a"]).cast("double") * F.size(p["b"]))
        return F.when(norm > 0, F.size(F.array_intersect(p["a"], p["b"])) / norm).otherwise(F.lit(0.0))

    return let(F.struct(a.alias("a"), b.alias("b")), cosine)


def filled(template: Column, slots: dict[str, Column]) -> Column:
    """Replace every ``{name}`` by its column."""
    for name, value in slots.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template
