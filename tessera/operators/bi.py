"""Statistics questions: SQL over named tables, growth, reports, clusters."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.functions.text import words
from tessera.operators.search import top_k


class SqlTables:
    """Named tables with column notes, and SQL over them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.notes = spark, {}

    def add(self, name: str, df: DataFrame, notes: dict[str, str] | None = None) -> SqlTables:
        df.createOrReplaceTempView(name)
        self.notes[name] = notes or {}
        return self

    def query(self, sql: str) -> DataFrame:
        return self.spark.sql(sql)

    def records(self, sql: str) -> DataFrame:
        """Every row as a JSON record."""
        return self.spark.sql(sql).select(F.to_json(F.struct("*")).alias("record"))


# Width of the hashed term vectors.
HASHED_TERMS = 1 << 18


def most_frequent(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def profit(df: DataFrame, group: str, price: Column, cost: Column, quantity: Column) -> DataFrame:
    return df.groupBy(group).agg((F.sum(price * quantity) - F.sum(cost * quantity)).alias("profit"))


def monthly_growth(df: DataFrame, when: Column, amount: Column) -> DataFrame:
    """``month, total, prev_month, prev_year, mom, yoy`` for every month of the range.

    Months without rows count as 0. The earlier months come by equi-joins on the month.
    """
    month = F.trunc(when.cast("date"), "month")
    totals = df.groupBy(month.alias("month")).agg(F.sum(amount).alias("total"))
    span = totals.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    calendar = span.select(F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))
    filled = calendar.join(totals, "month", "left").select("month", F.coalesce("total", F.lit(0.0)).alias("total"))
    shifted = lambda n, name: filled.select(F.add_months("month", n).alias("month"), F.col("total").alias(name))
    joined = filled.join(shifted(1, "prev_month"), "month", "left").join(shifted(12, "prev_year"), "month", "left")
    growth = lambda c: F.when(F.col(c) != 0, (F.col("total") - F.col(c)) / F.col(c))
    return joined.withColumn("mom", growth("prev_month")).withColumn("yoy", growth("prev_year"))


def with_fallback(result: DataFrame, fallback: DataFrame, value: str) -> DataFrame:
    """The result rows with ``source = sql``; the fallback rows if the result is empty or zero.

    ``chart`` is true when the result has more than one row.
    """
    stats = result.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col(value), F.lit(0)) != 0).alias("good"))
    n, good = stats.select("n").scalar(), stats.select("good").scalar()
    first = result.withColumn("source", F.lit("sql")).withColumn("chart", n > 1).filter(good > 0)
    second = fallback.withColumn("source", F.lit("text")).withColumn("chart", F.lit(False)).filter(good == 0)
    return first.unionByName(second)


def title_clusters(titles: DataFrame, key: str, title: str, k: int = 5, seed: int = 42, examples: int = 3) -> DataFrame:
    """TF-IDF without stop words, k-means: ``cluster, size, examples``."""
    tokens = titles.select(key, title, words(F.col(title)).alias("tokens"))
    clean = StopWordsRemover(inputCol="tokens", outputCol="kept").transform(tokens)
    counts = HashingTF(inputCol="kept", outputCol="tf", numFeatures=HASHED_TERMS).transform(clean)  # keeps every term
    weighted = IDF(inputCol="tf", outputCol="features").fit(counts).transform(counts)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(weighted)
    placed = model.transform(weighted).select(key, title, "cluster")
    size = placed.groupBy("cluster").agg(F.count("*").alias("size"))
    shown = top_k(placed.withColumn("score", F.lit(0)), ["cluster"], examples, [key])
    texts = F.array_sort(F.collect_list(F.struct("rk", title))).alias("t")
    packed = shown.groupBy("cluster").agg(texts).select("cluster", F.array_join(f"t.{title}", "; ").alias("examples"))
    return size.join(packed, "cluster")


def extracted_fields(docs: DataFrame, rules: dict[str, Column], text: str, path: Column) -> DataFrame:
    """A table from documents: one column per rule, plus id and path."""
    return docs.select(F.sha2(text, 256).alias("id"), path.alias("path"), *[c.alias(n) for n, c in rules.items()])
