"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of documents, but for
the last, which returns the encoded documents. The runner writes each result as Parquet and reads it
again as the next stage's input; ``run`` does the same in the shared folder.

1. quality: documents that the quality rules reject go.
2. near copies: of each group of documents that link at a Jaccard similarity of 0.75 over five-word
   shingles, the one with the least id stays.
3. repeated substrings: bytes that an earlier string of 100 bytes covers are cut out; the rest of a
   character that is cut in two goes as well, and n_chars is counted anew.
4. benchmark: documents that the contamination rule names go; the others lose the hit spans of 13 words
   or more (n_chars is counted anew for them) and stay as they are without such spans.
5. pieces: a reproducible sampled segmentation of each text; a row for each document.

Null, empty, repeated and clashing columns are handled as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from actuspark.llm import decontam, jaccard, pieces, quality, suffix
from actuspark.llm.shared import save, table


#: Characters of distinct parts whose lattices a worker remembers in the last stage.
PIECE_NODES = 1_000_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.representatives(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = suffix.dedup(docs, carry=rest, keep_text="text").withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*[F.col(f"rest.{c}").alias(c) if c in rest else F.col(c) for c in docs.columns])


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    judged = decontam.verdicts(decontam.find(docs, table(spark, sf_dir, "benchmark"), carry=rest)).where(~F.col("contaminated"))
    # A table between the two, so that an executor runs one Python step at a time and keeps no more workers than cores.
    cut = decontam.strip(save(judged))
    kept = {c: F.col(f"rest.{c}") for c in rest} | {"doc_id": F.col("k"), "text": F.col("text")}
    if "n_chars" in rest:
        kept["n_chars"] = F.when(F.col("n_cut") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("rest.n_chars"))
    return cut.select(*[kept[c].alias(c) for c in docs.columns])


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Executors still hold what earlier stages needed, so the memory of lattices is kept smaller here.
    return pieces.encode(docs, nodes=PIECE_NODES)


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("repeats", repeats_stage),
    ("benchmark", benchmark_stage),
    ("pieces", pieces_stage),
]

#: Sampled segmentations can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
