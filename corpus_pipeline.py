"""Training-data pipeline over ``documents``: five stages, each one of the operators.

1. ``language``: drop documents in which no learned language can be told (operator 10).
2. ``near_duplicates``: keep one document of each group of near copies (operator 5).
3. ``surrogates``: replace personal data and secrets (operator 8).
4. ``mix``: take whole documents by source until the word budget is used up; a source below
   its target is taken up to three times, so documents can repeat (operator 3).
5. ``tokens``: token ids of every whole text, and whether they decode to it (operator 7).

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import bpe, language, minhash, mixing, pii
from tickforge.llm.common import stored
from tickforge.llm.queries import surrogate_key, tokenizer_path

#: SQL cannot express these stages; tests/llm/test_pipeline.py follows them by brute force.
ORACLE_SQL = None


#: Scores below this many times that of a guess say that a text is in none of the languages.
GUESS = 1.2


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which no learned language can be told: null texts and texts without any letter, and texts
    whose best language is hardly likelier than a guess (:data:`GUESS` times one in the number of languages).

    The network is trained on a bounded sample of the stage's own labelled rows. The predicted
    language replaces ``lang`` where that is null; given languages stay. Where no row has a language there is nothing to
    learn, and only texts without a letter go. Repeated rows are judged alike; an empty table stays empty.
    """
    model = language.fit(docs)
    if not model.labels:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language.identify(docs, model, pred="__pred", score="__score")
    sure = F.col("__score") >= (GUESS / len(model.labels) if len(model.labels) > 1 else 0.0)
    kept = found.filter((F.col("__pred") != "und") & sure).withColumn("lang", F.coalesce("lang", "__pred"))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity of 80 % or more; the smallest ``doc_id`` of a group stays.

    Documents without words are no copies of one another and stay.
    """
    found = minhash.near_duplicates(docs, width=5, percent=80)
    drop = found.filter("not kept").select(F.col("doc_id").alias("__drop"))
    # Joined by shuffling at every size: the dropped keys grow with the corpus.
    return docs.join(drop.hint("merge"), F.col("doc_id") == F.col("__drop"), "left_anti").select(*docs.columns)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; ``n_chars`` follows the new text."""
    out = pii.replace_pii(docs, surrogate_key(spark))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for every copy that the mix takes."""
    return mixing.repeated(mixing.mix(docs), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, source, n_tokens, ids_sha256, decoded_sha256, round_trip`` of every row."""
    path = tokenizer_path("byte_bpe_50k.json")
    ids = bpe.encode(docs.select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"), "text"), path)
    back = bpe.decode(ids, path)
    decoded = F.sha2(F.col("text"), 256)
    return back.select("doc_id", "source", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), decoded.alias("decoded_sha256"),
                       (decoded == F.col("sha")).alias("round_trip"))


STAGES = [("language", detect_language), ("near_duplicates", near_duplicates), ("surrogates", surrogates),
          ("mix", mix), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder, each written to the shared folder in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
