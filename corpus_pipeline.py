"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, decontamination, SentencePiece.

Each stage takes the documents its predecessor kept and returns the columns of `documents`; the last
returns the encoded documents. A document's other columns pass through unchanged, whatever their names (but
`n_chars`, which follows the text). `run` writes each stage as Parquet in the shared folder and reads it
back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart.llm import common, decontaminate, line_dedup, piece_codec, queries, simhash, toxicity

#: No SQL twin: nearest neighbours, alignment and piece encoding are beyond it; tests use brute force.
ORACLE_SQL = None


def _numbered(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The documents with their columns numbered, so that none bears a name of an operator's, and the new
    names of the id and the text."""
    names = docs.columns
    inner = docs.toDF(*[f"in_{n}" for n in range(len(names))])
    return inner, f"in_{names.index('doc_id')}", f"in_{names.index('text')}"


def _with_key(docs: DataFrame) -> DataFrame:
    """Numbered documents with the key `(_k, _h)` of id and text by which operators tell them apart."""
    inner, doc_id, text = _numbered(docs)
    return inner.withColumns(
        {
            "_k": F.coalesce(F.col(doc_id).cast("long"), F.lit(common.SMALLEST)),
            "_h": F.xxhash64(F.coalesce(text, F.lit(""))),
        }
    )


def _named(numbered: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents, under their names again."""
    return numbered.select(*[f"in_{n}" for n in range(len(docs.columns))]).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity score does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    inner, doc_id, text = _numbered(docs)
    return _named(toxicity.score(inner, labels, doc_id, text).where(F.col("score") < 0.5), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines aligned with an earlier one."""
    inner, doc_id, text = _numbered(docs)
    done = line_dedup.dedup(inner, id_col=doc_id, text_col=text)
    changed = F.col("n_removed") > 0
    columns = {text: F.when(changed, F.col("kept_text")).otherwise(F.col(text))}
    if "n_chars" in docs.columns:
        n_chars = inner.columns[docs.columns.index("n_chars")]
        columns[n_chars] = F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col(n_chars))
    return _named(done.withColumns({f"new_{c}": value for c, value in columns.items()}).drop(*columns).withColumnsRenamed(
        {f"new_{c}": c for c in columns}), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, of equal ids the smallest text hash."""
    found = simhash.near_duplicates(docs.select("doc_id", "text"))
    kept = found.groupBy("root").agg(F.min(F.struct("k", "h")).alias("kept"))
    keys = kept.select(F.col("kept.k").alias("_k"), F.col("kept.h").alias("_h"))
    return _named(_with_key(docs).join(keys, ["_k", "_h"], "left_semi").dropDuplicates(["_k", "_h"]), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth stands in the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = decontaminate.contamination(docs.select("doc_id", "text"), benchmark)
    bad = judged.where(queries.is_contaminated()).select(F.col("k").alias("_k"), F.col("h").alias("_h"))
    return _named(_with_key(docs).join(bad.distinct(), ["_k", "_h"], "left_anti"), docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document left."""
    return queries.piece_digests(piece_codec.encode_decode(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
