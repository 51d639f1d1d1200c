"""Line deduplication over all documents.

Lines are exploded to (hash of the key, document, position); a hash found in
enough documents is common, and common lines go everywhere except in the
document with the largest id. Positions to drop go back to their document,
whose lines are joined again in order. The texts themselves are shuffled once.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from keylane.llm.shared import aside, documents, small_batches, text_or_empty
from keylane.session import stored

LEAST_CHARS = 40
LEAST_DOCUMENTS = 5
#: Parts of a line's documents; each line's keeper is sent to the parts that hold it.
SALTS = 256
_BLANK = " \t\n\x0b\x0c\r"


def _common_lines(docs: DataFrame, least_chars: int, least_documents: int) -> DataFrame:
    """Rows (doc_id, text_key, drops): positions of the lines that go, for documents that lose any."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(_BLANK)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    long = lines.select("doc_id", "text_key", "pos", key.alias("key")).filter(F.char_length("key") >= least_chars)
    # 128 bits tell all keys apart; the text of a line goes no further
    hashed = long.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "doc_id", "text_key", "pos")
    # a line's rows are dealt by document as well, so that a line which a third of the documents hold has many tasks
    held = stored(hashed.groupBy("h1", "h2", _salt(), "doc_id").agg(F.collect_set(F.struct("text_key", "pos")).alias("at")), "lines")
    parts = held.groupBy("h1", "h2", "salt").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
    common = parts.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper")).filter(
        F.col("n") >= least_documents).select("h1", "h2", "keeper")
    gone = held.join(parts.select("h1", "h2", "salt").join(common, ["h1", "h2"]), ["h1", "h2", "salt"]).filter(
        ~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return gone.select("doc_id", F.explode("at").alias("x")).groupBy("doc_id", F.col("x.text_key").alias("text_key")).agg(
        F.collect_set("x.pos").alias("drops"))


def _salt() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt")


@F.pandas_udf(StringType())
def _without(text: pd.Series, drops: pd.Series) -> pd.Series:
    def kept(value: str, gone) -> str:
        if gone is None or not len(gone):
            return value
        out = set(gone.tolist())
        return "\n".join(line for i, line in enumerate(value.split("\n")) if i not in out)
    return pd.Series([kept(t, d) for t, d in zip(text, drops, strict=True)], dtype=object)


def drop_common_lines(docs: DataFrame, keep: list[str], least_chars: int = LEAST_CHARS,
                      least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """The columns ``keep`` of the documents with ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    A null text is one empty line. A missing doc_id counts as one document,
    smaller than all others. Rows that repeat an id are one document; a row is
    told from others of its id by its text.
    """
    small_batches(docs.sparkSession)
    drops = _common_lines(docs, least_chars, least_documents).select(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "drops")
    held, names = aside(docs)
    doc_id, text = names["doc_id"], text_or_empty(names["text"])
    rows = held.withColumn("text_key", F.xxhash64(names["text"]))
    joined = rows.join(drops, F.col(doc_id).eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key")), "left")
    return joined.select(
        *[F.col(names[c]).alias(c) for c in keep], _without(text, F.col("drops")).alias("kept_text"),
        (F.char_length(text) - F.char_length(F.translate(text, "\n", "")) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))


def without_common_lines(docs: DataFrame) -> DataFrame:
    """The documents with their kept text, and ``n_chars``, where there is one, counted again.

    A document that loses all its lines stays, with an empty text; a null text stays null.
    """
    held, names = aside(docs)
    kept = drop_common_lines(held.withColumnsRenamed({names["doc_id"]: "doc_id", names["text"]: "text"}),
                             [{"doc_id": "doc_id", "text": "text"}.get(c, names[c]) for c in docs.columns])
    changed = kept.withColumn("text", F.when(F.col("text").isNotNull(), F.col("kept_text")))
    if "n_chars" in names:
        changed = changed.withColumn(names["n_chars"], F.char_length(text_or_empty()).cast(docs.schema["n_chars"].dataType))
    return changed.drop("kept_text", "n_lines", "n_dropped").toDF(*docs.columns)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_common_lines(documents(spark, sf_dir), ["doc_id"]).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
