"""The training-data operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, content, hard_negatives, language, mixing, multi_index, packing, prefix_trie, secret_scan, simhash, topk, toxicity, warc
from ledgerloom.llm.common import read, scratch

#: The vocabulary of the tokenizing queries; a path, never a copy.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Rows with these ids are the queries of a search.
QUERY_STEP = 20


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents and pages, by their text, what they
    declare, and their source or host (one set of priors for both)."""
    documents = read(spark, sf_dir, "documents").select(
        "doc_id", F.lit(None).cast("long").alias("page_id"), "text", F.col("lang").alias("declares"),
        F.col("source").alias("address"), F.lit(False).alias("markup"))
    pages = read(spark, sf_dir, "pages").select(
        F.lit(None).cast("long").alias("doc_id"), "page_id", F.col("html").alias("text"),
        language.markup_language(F.col("html")).alias("declares"), F.col("url").alias("address"), F.lit(True).alias("markup"))
    return language.identify(documents.unionByName(pages), "text", F.col("declares"), F.col("address"), F.col("markup"),
                             keep=("doc_id", "page_id"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate secret of all documents with the forest's verdict; the
    string itself is given by its digest."""
    found = secret_scan.score(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "at", "start", F.length("candidate").alias("length"),
                        F.sha2("candidate", 256).alias("candidate_sha256"), "chance", "is_secret")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens: a row per piece."""
    return packing.pack(read(spark, sf_dir, "documents"), TOKENIZER, capacity=1024, end_id=0)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of near ones."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC bundles and read back from them."""
    path = scratch(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), path)
    return warc.read_records(spark, path, with_payload=False).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors with equal labels."""
    return multi_index.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return content.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    return bpe.digests(read(spark, sf_dir, "documents"), TOKENIZER)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products for each query vector."""
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % QUERY_STEP == 0, k=20)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words a mix of the sources takes of each document."""
    return mixing.mix(read(spark, sf_dir, "documents"), weights=(1, 2, 3), epochs=3)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations: a row per distinct prefix."""
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hardest negatives of each anchor vector and positive."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label, positives=5, negatives=5, low=80, high=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_toxicity, op3_secret_scan, op4_packing, op5_simhash, op6_warc, op7_multi_index,
                            op8_content, op9_bpe, op10_topk, op11_mixing, op12_prefix_trie, op13_hard_negatives)
}

#: Integer scores, so DuckDB's answer must equal Spark's in every row.
_TOPK_SQL = """
with v as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as w
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.row, q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(range(1, len(q.w) + 1), lambda i: q.w[i] * c.w[i])) as bigint) as score
  from v q join v c on q.row <> c.row
  where q.vec_id % 20 = 0),
ranked as (
  select *, cast(row_number() over (partition by row order by score desc, vec_id) as int) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

#: Documents of a source by their MD5 place: how many words lie before each one.
_MIXING_SQL = """
with d as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
         md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as hash
  from documents),
s as (
  select source, sum(size) as n, cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint) as w
  from d group by source),
f as (  -- sources by how soon their target reaches three times their size
  select *, sum(n) over () as total,
         coalesce(sum(3 * n) over (order by n / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as used,
         sum(w) over (order by n / w desc, source desc nulls first rows between unbounded preceding and current row) as left_w
  from s),
c as (select *, 3 * n * left_w <= (total - used) * w as full_ from f),
r as (
  select max(total) - coalesce(sum(3 * n) filter (where full_), 0) as rest, coalesce(sum(w) filter (where not full_), 0) as over from c),
t as (
  select source, n, case when full_ then cast(3 * n as double)
         else cast(rest as double) * cast(w as double) / cast(over as double) end as target
  from c cross join r),
p as (
  select d.doc_id, d.source, d.size, t.n, t.target,
         sum(d.size) over (partition by d.source order by substr(d.hash, 1, 15), d.doc_id rows between unbounded preceding and current row) - d.size as before
  from d join t on d.source is not distinct from t.source)
select doc_id, source, size, cast(n as bigint) as source_size, target,
       cast(case when n = 0 then 0 else
         (cast(floor(target) as bigint) // n) * size
         + greatest(0, least(size, cast(floor(target) as bigint) % n - before)) end as bigint) as taken
from p
"""

#: Plain products of whole numbers.
_HARD_NEGATIVES_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as w
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         cast(list_sum(list_transform(range(1, len(a.w) + 1), lambda i: a.w[i] * c.w[i])) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id
  where a.vec_id % 100 = 0),
p as (
  select *, row_number() over (partition by anchor_id order by score desc, vec_id) as place from scored where same),
n as (
  select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
         cast(row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as int) as rank
  from p join scored s on s.anchor_id = p.anchor_id
  where p.place <= 5 and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 5
"""

#: Prefixes as joined digests of turns; CRC-32 bit by bit.
_PREFIX_TRIE_SQL = """
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first) as p,
         md5(cast(len(coalesce(role, '')) as varchar) || ':' || coalesce(role, '') || coalesce(text, '')) as code,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as words
  from conversations where conv_id is not null),
c as (
  select conv_id, xor(list_reduce(
           list_concat([4294967295::bigint], list_transform(string_split(cast(conv_id as varchar), ''), lambda ch: ord(ch)::bigint)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
             lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 4 as h
  from (select distinct conv_id from t) q),
r as (
  select c.conv_id, t.p, t.code, t.words from c join t on t.conv_id = c.conv_id - c.conv_id % 20 where t.p <= c.h
  union all
  select c.conv_id, t.p, t.code, t.words from c join t on t.conv_id = c.conv_id where t.p > c.h),
m as (
  select conv_id, 0 as d, '' as prefix, '' as above, 0 as words from c
  union all
  select conv_id, row_number() over w as d, string_agg(code, '') over w as prefix,
         coalesce(string_agg(code, '') over (partition by conv_id order by p rows between unbounded preceding and 1 preceding), '') as above, words
  from r window w as (partition by conv_id order by p rows between unbounded preceding and current row)),
e as (select conv_id, max(d) as length from m group by conv_id),
n as (
  select prefix, d, min(above) as above, min(m.conv_id) as conv_id, count(*) as n_convs, max(words) as words,
         coalesce(string_agg(case when d = length then cast(m.conv_id as varchar) end, ',' order by m.conv_id), '') as ends
  from m join e on e.conv_id = m.conv_id group by prefix, d),
k as (select above, count(*) as n_children from n where d > 0 group by above),
f as (select n.*, coalesce(k.n_children, 0) as n_children from n left join k on k.above = n.prefix),
s as (
  select m.prefix, sum(case when f.n_children = 0 then 1 else 0 end) as n_leaves, sum((f.n_convs - 1) * f.words) as saved
  from f join m on m.conv_id = f.conv_id and m.d <= f.d group by m.prefix)
select f.conv_id, cast(f.d as bigint) as depth, p.conv_id as parent_conv_id, cast(f.n_convs as bigint) as n_convs,
       cast(f.n_children as bigint) as n_children, cast(s.n_leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens,
       sha256(f.ends) as ends_sha256
from f join s on s.prefix = f.prefix left join n p on f.d > 0 and p.prefix = f.above
"""

ORACLE_SQL: dict[str, str] = {"op10_topk": _TOPK_SQL, "op11_mixing": _MIXING_SQL, "op12_prefix_trie": _PREFIX_TRIE_SQL,
                              "op13_hard_negatives": _HARD_NEGATIVES_SQL}
