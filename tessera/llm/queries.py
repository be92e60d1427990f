"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import alignment, chat, decontaminate, langid, licenses, lines, near, packing, pieces, repair, substrings, vectors, warc

TOKENIZER = str(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence columns of every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text")


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    return warc.captures(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return langid.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


# The conversation that every run adds.
EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and read back."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA, "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_conversations(turns.unionByName(extra), TOKENIZER))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)


@query
def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines."""
    return lines.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, on 2-word shingles."""
    return near.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), n=2, with_text=False).drop("first")

# Lines are trimmed of ASCII white space; blank ones are skipped.
ORACLE["op5_lines"] = """
with line as (
  select doc_id, i, unnest(string_split(text, chr(10))) as line from (select doc_id, text, 0 as i from documents where text is not null)),
numbered as (
  select doc_id, line, row_number() over (partition by doc_id) as place from line),
solid as (
  select doc_id, place, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as body,
         row_number() over (partition by doc_id order by place) - 1 as n
  from numbered where trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''),
three as (
  select a.doc_id, a.n, a.body as x, b.body as y, c.body as z
  from solid a join solid b on b.doc_id = a.doc_id and b.n = a.n + 1 join solid c on c.doc_id = a.doc_id and c.n = a.n + 2),
later as (
  select doc_id, n from (select doc_id, n, row_number() over (partition by x, y, z order by doc_id, n) as k from three) where k > 1),
gone as (
  select distinct doc_id, n + d as n from later, (values (0), (1), (2)) as t(d)),
kept as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.place) as text
  from numbered l left join solid s on s.doc_id = l.doc_id and s.place = l.place left join gone g on g.doc_id = s.doc_id and g.n = s.n
  where g.n is null group by l.doc_id),
lines as (select doc_id, count(*) as n_lines from solid group by 1),
removed as (
  select g.doc_id, count(*) as n_removed, count(*) filter (where p.n is null) as n_spans
  from gone g left join gone p on p.doc_id = g.doc_id and p.n = g.n - 1 group by 1)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text, coalesce(l.n_lines, 0) as n_lines, coalesce(r.n_removed, 0) as n_removed,
       coalesce(r.n_spans, 0) as n_spans
from documents d left join kept k using (doc_id) left join lines l using (doc_id) left join removed r using (doc_id)"""

ORACLE["op9_minhash"] = r"""
with recursive word as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingle as (
  select distinct doc_id, unnest(case when len(w) = 1 then w else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s from word where len(w) > 0),
size as (select doc_id, count(*) as n from shingle group by 1),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
link as (
  select a, b from shared s join size x on x.doc_id = a join size y on y.doc_id = b where 100 * s.n >= 80 * (x.n + y.n - s.n)),
reach(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, l.b from reach r join link l on l.a = r.other)
select d.doc_id, coalesce(any_value(s.n), 0)::bigint as n_shingles, min(r.other) as component_id, d.doc_id = min(r.other) as kept
from documents d join reach r on r.doc_id = d.doc_id left join size s on s.doc_id = d.doc_id group by d.doc_id"""


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and test item it holds."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


@query
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


ORACLE["op7_embeddings"] = """
with recursive sound as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
link as (
  select a.vec_id as a, b.vec_id as b from sound a join sound b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.98),
reach(vec_id, other) as (select vec_id, vec_id from embeddings union select r.vec_id, l.b from reach r join link l on l.a = r.other),
degree as (select a as vec_id, count(*) as n from link group by 1),
low as (select vec_id, min(other) as component_id from reach group by 1)
select e.vec_id, coalesce(d.n, 0)::bigint as n_links, l.component_id, e.vec_id = l.component_id as kept
from embeddings e join low l using (vec_id) left join degree d using (vec_id)"""


@query
def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated 100-byte strings."""
    return substrings.dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text read back from them."""
    return pieces.digests(table(spark, sf_dir, "documents", "doc_id", "text"), PIECES)


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, for every document."""
    return alignment.digests(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER, PIECES)


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by rule, and its cheapest repair."""
    return repair.damage_and_repair(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
