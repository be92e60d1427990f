"""Licence scan by ordered signature rules, in DataFrame functions only.

One narrow pass: nothing is shuffled. A document's text becomes normal text (lower-case words between single
blanks); rules whose two key words both occur are run over it; a detection that lies inside another of the same or
a better priority is suppressed in one sweep over the detections in order of their starts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.license_rules import BASE, PHRASES, SENTENCES, WEIGHT, rules

# Fixed value: what separates words once A-Z are lower-case.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

BLOCK = 256  # matches whose lengths are summed together


def normal_text(text: Column) -> Column:
    """Words between single blanks, one blank at each end; a text without words gives two blanks.

    ``lower`` also folds letters beyond A-Z. Words stay the same, since such a letter counts as part of a word before
    and after; the only one that becomes a bare ASCII letter is the Kelvin sign (k), which no base phrase has.
    """
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS, " ")), F.lit(" "))


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _base(normal: Column, spaced: Column, phrase: str) -> Column:
    """(places, first start, last start) of a phrase; ``spaced`` has each word between two blanks of its own."""
    size = len(phrase.split())
    pattern = " " + phrase.replace(" ", "  ") + " "
    parts = F.split(spaced, pattern)
    found = F.struct((F.size(parts) - 1).cast("long").alias("places"), (_blanks(parts[0]) / 2).cast("long").alias("first"),
                     ((_blanks(spaced) - _blanks(F.element_at(parts, -1))) / 2 - size).cast("long").alias("last"))
    none = F.struct(F.lit(0).cast("long").alias("places"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    return F.when(F.contains(normal, F.lit(f" {phrase} ")), found).otherwise(none)


def _rule_array() -> Column:
    """All rules, as one literal."""
    names = ["rule", "label", "rank", "one", "two", "pattern"]
    listed = [dict(zip(names, (i, label, rank, f" {one} ", f" {two} ", pattern))) for i, label, rank, one, two, pattern in rules()]
    return F.from_json(F.lit(json.dumps(listed)), "array<struct<rule:int,label:string,rank:int,one:string,two:string,pattern:string>>")


FOUND = "struct<start:int,minus_end:int,rank:int,rule:int,label:string>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _detections(normal: Column) -> Column:
    """All matches of all rules that pass their key words: start, end, rank, rule, label.

    The start of a match is the length of everything before it. Lengths are summed by blocks of matches, then block by block, so work
    stays near linear in a document's matches.
    """
    def matches(rule: Column) -> Column:
        gaps, texts = F.split(normal, rule["pattern"]), F.regexp_extract_all(normal, rule["pattern"], F.lit(0))
        # the last gap has no match after it
        parts = F.arrays_zip(gaps.alias("gap"), texts.alias("text"))

        def step(state: Column, part: Column) -> Column:
            start = state["at"] + F.length(part["gap"])
            end = start + F.length(part["text"])
            made = F.struct(start.alias("start"), (-end).alias("minus_end"), rule["rank"].alias("rank"), rule["rule"].alias("rule"), rule["label"].alias("label"))
            return F.when(part["text"].isNull(), state).otherwise(F.struct(end.alias("at"), F.concat(state["found"], F.array(made)).alias("found")))

        def block(parts: Column, b: Column) -> Column:
            return F.slice(parts, b * BLOCK + 1, F.lit(BLOCK))

        def located(parts: Column) -> Column:
            blocks = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int"))
            sizes = F.transform(blocks, lambda b: F.aggregate(block(parts, b), F.lit(0), lambda n, p: n + F.length(p["gap"]) + F.coalesce(F.length(p["text"]), F.lit(0))))

            def in_block(sizes: Column) -> Column:
                def found(_: Column, b: Column) -> Column:
                    before = F.aggregate(F.slice(sizes, F.lit(1), b), F.lit(0), lambda n, s: n + s)
                    none = F.struct(before.alias("at"), F.expr(f"cast(array() as array<{FOUND}>)").alias("found"))
                    return F.aggregate(block(parts, b), none, step, lambda state: state["found"])
                return F.flatten(F.transform(sizes, found))

            return _bound(sizes, in_block)

        return _bound(parts, located)

    open_rules = F.filter(_rule_array(), lambda r: F.contains(normal, r["two"]) & F.contains(normal, r["one"]))
    return F.flatten(F.transform(open_rules, matches))


def _survivors(detections: Column) -> Column:
    """Labels and best rank left after suppression.

    In order of (start, longest first, rank, rule) a detection is suppressed if one before it, of its rank or a
    better one, ends no earlier. ``reach`` keeps the furthest end per rank.
    """
    empty = F.struct(F.array(*[F.lit(-1)] * 3).alias("reach"), F.lit(None).cast("array<string>").alias("labels"), F.lit(9).alias("best"))
    start = F.struct(empty["reach"], F.expr("cast(array() as array<string>)").alias("labels"), F.lit(9).alias("best"))

    def step(state: Column, d: Column) -> Column:
        end = -d["minus_end"]
        hidden = F.exists(F.slice(state["reach"], 1, d["rank"]), lambda e: e >= end)
        reach = F.transform(state["reach"], lambda e, i: F.when((i == d["rank"] - 1) & (e < end), end).otherwise(e))
        return F.when(hidden, state).otherwise(F.struct(reach.alias("reach"), F.array_union(state["labels"], F.array(d["label"])).alias("labels"),
                                                        F.least(state["best"], d["rank"]).alias("best")))

    return F.aggregate(F.array_sort(detections), start, step)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the licence columns added (a column of that name is replaced).

    n_words, n_base (places of the base phrases), first_word and last_word (their smallest and largest start, null
    without one), base_labels, labels (with the rules'; both distinct, sorted, joined by commas), score in [0, 1]:
    1 for a base phrase or an exact tag, 0.9 for a whole licence phrase, 0.6 for a bare name, 0 for nothing.
    A null, empty or wordless text has no words and no labels. Texts are read whole; work grows nearly in proportion to
    a text's length and matches (60,000 matches in one text take some seconds). Rows are kept as they come: repeated rows get equal
    results, ties between rules go to the better priority, then the longer match, then the earlier rule.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns]
    step = docs.select(*kept, normal_text(F.col(f"`{text}`")).alias("__normal"))
    spaced = F.replace(F.col("__normal"), F.lit(" "), F.lit("  "))
    # the ends have one blank more than a word needs
    spaced = F.substring(spaced, F.lit(2), F.length(spaced) - 2)
    normal = F.col("__normal")
    keys = sorted({key for _, key, _ in PHRASES} | {two for _, _, two, _, _ in SENTENCES})
    gate = F.lit(False)
    for key in keys:
        gate = gate | F.contains(normal, F.lit(f" {key} "))
    nothing = F.expr(f"cast(array() as array<{FOUND}>)")
    step = step.select(*kept, "__normal", F.when(gate, _detections(normal)).otherwise(nothing).alias("__found"),
                       F.array(*[_base(normal, spaced, p) for p, _ in BASE]).alias("__base"))
    step = step.withColumn("__left", _survivors(F.col("__found")))
    base = F.col("__base")
    labels = F.filter(F.array(*[F.when(base[i]["places"] > 0, F.lit(label)) for i, (_, label) in enumerate(BASE)]), lambda x: x.isNotNull())
    places = sum((base[i]["places"] for i in range(1, len(BASE))), base[0]["places"])
    rank_weight = F.create_map(*[F.lit(x) for pair in WEIGHT.items() for x in pair])
    made = {
        "n_words": F.when(normal == "  ", F.lit(0)).otherwise(F.size(F.split(normal, " ")) - 2).cast("long"),
        "n_base": places,
        "first_word": F.array_min(F.transform(base, lambda b: b["first"])),
        "last_word": F.array_max(F.transform(base, lambda b: b["last"])),
        "base_labels": F.array_join(F.array_sort(F.array_distinct(labels)), ","),
        "labels": F.array_join(F.array_sort(F.array_union(labels, F.col("__left")["labels"])), ","),
        "score": F.when(places > 0, F.lit(1.0)).otherwise(F.coalesce(rank_weight[F.col("__left")["best"]], F.lit(0.0))),
    }
    return step.select(*[F.col(f"`{c}`") for c in docs.columns if c not in made], *[v.alias(k) for k, v in made.items()])
