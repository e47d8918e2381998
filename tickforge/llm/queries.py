"""Registered queries of the training-data operators, over whole tables.

Each query applies one operator with production parameters and derives the
columns that its contract asks for. Queries that SQL cannot express, or cannot
run fast enough on whole tables, are tested against brute force in tests/llm.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import (bitplane, bpe, embedding_dedup, fingerprint, hard_negatives, html_mrf, language, merkle,
                           minhash, mixing, pii, quality_cnn, quality_rules)
from tickforge.llm.common import table
from tickforge.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file (the folder is a setting of the machine)."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def surrogate_key(spark: SparkSession) -> str:
    """The key of surrogates: a setting of the job, with a value for tests."""
    return spark.conf.get("spark.tickforge.surrogateKey", "set-your-own-key")


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted fair queueing of all documents: words taken from each document."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"), F.col("copies").cast("long"))


@query
def op6_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as bit-plane files and read back."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "token-ids")
    bitplane.write_ids(docs, folder, tokenizer_path("word_bpe_49k.json"), end_id=1)
    back = bitplane.read_ids(spark, folder)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents")
    return bpe.digest(docs, tokenizer_path("byte_bpe_50k.json"))


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents: three-word shingles, similarity of 85 % or more."""
    docs = table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, width=3, percent=85)


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents, cutoffs certified on all labels, strata by language."""
    out = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", F.array_join("reasons", ",").alias("reasons"))


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data and secrets replaced by surrogates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.replace_pii(docs, surrogate_key(spark))
    return out.select("doc_id", "text", "n_entities")


def crc_mod(key: str, n: int):
    """Remainder of the unsigned CRC-32 of a key written as text."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; documents of remainder 2 (mod 4) are held out of training."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = language.fit(docs.filter(~held))
    out = language.identify(docs.select("doc_id", held.alias("held_out"), "text"), model)
    return out.drop("text")


@query
def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; labels of remainder 1 (mod 3) are held out of training."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    model = quality_cnn.fit(docs.filter(~held), table(spark, sf_dir, "labels").filter(~held))
    return quality_cnn.classify(docs.select("doc_id", held.alias("held_out"), "text"), model).drop("text")


@query
def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    out = html_mrf.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of the whole table, cosine of 0.95 or more."""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents by language, and a version for each that is tampered with."""
    docs = table(spark, sf_dir, "documents")
    # Wider than a long, so that one more always fits.
    more = F.when(crc_mod("doc_id", 7) == 0, F.col("n_chars").cast("decimal(20,0)") + 1)
    out = merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], keep=["doc_id"],
                          changes={"n_chars": more.cast("string")})
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "siblings"), 256).alias("proof_sha256"),
                      F.col("version_root").alias("folded_root"), (F.col("version_root") == F.col("root")).alias("verified"))


# The tree level by level: a node is the hash of two neighbours, and every document follows its ancestors.
ORACLES["op11_manifest"] = """
with recursive bits as (
  select doc_id, list_reduce(
      list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast(doc_id as varchar), ''),
          lambda ch: [ascii(ch)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, b: xor(xor(c, b) >> 1, 3988292384::bigint * (xor(c, b) & 1))) as reg
  from (select distinct doc_id from documents where doc_id is not null)),
crc as (select doc_id, xor(reg, 4294967295::bigint) % 7 = 0 as hit from bits),
base as (
  select d.doc_id, d.lang, d.n_chars, coalesce(c.hit, false) and d.n_chars is not null as hit,
         coalesce(strlen(cast(d.doc_id as varchar)) || ':' || cast(d.doc_id as varchar), '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') as head,
         coalesce(strlen(text) || ':' || text, '-') as tail
  from documents d left join crc c on d.doc_id = c.doc_id),
leaves as (
  select doc_id, lang, sha256(head || coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') || tail) as leaf,
         case when hit then sha256(head || strlen(cast(n_chars + 1 as varchar)) || ':' || cast(n_chars + 1 as varchar) || tail) end as bad
  from base),
placed as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
                  count(*) over (partition by lang) as n from leaves),
nodes as (
  select lang, 0 as lvl, pos as idx, n, leaf as digest from placed
  union all
  select lang, any_value(lvl) + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' order by idx))
  from nodes where n > 1 group by lang, idx // 2),
subroots as (select lang, digest as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n
             from nodes where n = 1),
upper_nodes as (
  select 0 as lvl, pos as idx, n, subroot as digest from subroots
  union all
  select any_value(lvl) + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' order by idx))
  from upper_nodes where n > 1 group by idx // 2),
walk as (
  select lang, pos, 0 as lvl, pos as idx, n, '' as proof, coalesce(bad, leaf) as digest from placed
  union all
  select w.lang, w.pos, w.lvl + 1, w.idx // 2, (w.n + 1) // 2, w.proof || coalesce(s.digest, ''),
         sha256(case when w.idx % 2 = 1 then coalesce(s.digest, '') || w.digest else w.digest || coalesce(s.digest, '') end)
  from walk w left join nodes s on s.lang is not distinct from w.lang and s.lvl = w.lvl and s.idx = xor(w.idx, 1)
  where w.n > 1),
upper_walk as (
  select w.lang, w.pos, 0 as lvl, s.pos as idx, s.n, w.proof, w.digest
  from walk w join subroots s on s.lang is not distinct from w.lang where w.n = 1
  union all
  select w.lang, w.pos, w.lvl + 1, w.idx // 2, (w.n + 1) // 2, w.proof || coalesce(s.digest, ''),
         sha256(case when w.idx % 2 = 1 then coalesce(s.digest, '') || w.digest else w.digest || coalesce(s.digest, '') end)
  from upper_walk w left join upper_nodes s on s.lvl = w.lvl and s.idx = xor(w.idx, 1)
  where w.n > 1)
select p.doc_id, p.leaf, s.subroot, (select digest from upper_nodes where n = 1) as root,
       sha256(w.proof) as proof_sha256, w.digest as folded_root,
       w.digest = (select digest from upper_nodes where n = 1) as verified
from placed p
join subroots s on s.lang is not distinct from p.lang
join upper_walk w on w.lang is not distinct from p.lang and w.pos = p.pos and w.n = 1"""


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all vectors; every seventh has a shifted label."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), lambda key: key % 100 == 0)


ORACLES["op12_hard_negatives"] = """
with q as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
         cast(list_dot_product(a.v, b.v) as bigint) as score
  from q a join q b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
ranked as (
  select p.anchor_id, p.positive_id, n.other_id as negative_id, p.positive_score, n.score as negative_score,
         cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id) as integer) as rank
  from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
       and 80 * p.positive_score <= 100 * n.score and 100 * n.score <= 100 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ranked where rank <= 5"""


@query
def op13_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    return fingerprint.edited_likeness(table(spark, sf_dir, "documents"))
