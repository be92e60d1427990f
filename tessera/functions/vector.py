"""Vector measures of two array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, p: acc + p)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def clamped_cosine(a: Column, b: Column) -> Column:
    """0 when either norm is 0, then limited to [0, 1]."""
    size = norm(a) * norm(b)
    value = F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def euclid(a: Column, b: Column) -> Column:
    def square(x, y):
        d = x.cast("double") - y.cast("double")
        return d * d

    return F.sqrt(F.aggregate(F.zip_with(a, b, square), F.lit(0.0), lambda acc, d: acc + d))


def blend(a: Column, b: Column, wa: float, wb: float) -> Column:
    """Weighted sum of two vectors."""
    return F.zip_with(a, b, lambda x, y: x.cast("double") * wa + y.cast("double") * wb)


def rows_of(a: Column, width: int) -> Column:
    """Cut a vector into a matrix with rows of ``width`` values."""
    return F.transform(F.sequence(F.lit(1), F.size(a), F.lit(width)),
                       lambda i: F.slice(a, i, F.lit(width)))


def max_sim(query: Column, node: Column) -> Column:
    """Sum over query rows of the best inner product with any node row."""
    best = F.transform(query, lambda q: F.array_max(F.transform(node, lambda d: dot(q, d))))
    return F.aggregate(best, F.lit(0.0), lambda acc, x: acc + x)


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def sign_bits(a: Column) -> Column:
    """Signs of any number of values: one bigint per 64 of them."""
    bits = F.transform(a, lambda x, i: F.when(x >= 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i % 64))
                       .otherwise(F.lit(0).cast("bigint")))
    words = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / 64).cast("int")), lambda w: F.slice(bits, w * 64 + 1, F.lit(64)))
    return F.transform(words, lambda word: F.aggregate(word, F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(b)))


def hamming(a: Column, b: Column) -> Column:
    """Differing signs of two ``sign_bits`` columns."""
    apart = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda acc, n: acc + n)


def sparse_dot(a: Column, b: Column) -> Column:
    """Inner product of two map<term, weight> columns."""
    shared = F.map_keys(F.map_filter(a, lambda k, v: F.map_contains_key(b, k)))
    return F.aggregate(shared, F.lit(0.0), lambda acc, k: acc + F.element_at(a, k) * F.element_at(b, k))
