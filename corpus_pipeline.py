"""A training corpus from raw documents, in five stages of the operators in ``bidscope/llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bidscope.llm import line_dedup, mixing, ngram_join, quality_rules, sentencepiece_bpe
from bidscope.llm.scratch import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near duplicates: five-word shingles, Jaccard similarity of 0.8 or more.
NEAR = ngram_join.NgramJoin(width=5, similarity=line_dedup.Fraction(4, 5))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the base rules or their host's binding rules reject go."""
    return quality_rules.good_documents(docs.select(*COLUMNS))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: lines similar to an earlier line go; a document that loses all it says goes with them."""
    left = line_dedup.dedup_lines(docs, keep=("lang", "source", "n_chars"))
    left = left.filter((F.col("n_removed") == 0) | (F.col("text") != ""))
    changed = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text"))
    return left.withColumn("n_chars", changed.cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each component of near duplicates the row with the smallest doc_id stays, the first in order of texts.

    Rows of one doc_id with different texts are documents of their own; of its rows
    with equal texts one stays. Rows with a null doc_id are linked with nothing and stay.
    """
    docs = docs.select(*COLUMNS)
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    several = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min(text).alias("low"), F.max(text).alias("high")).filter("low < high")
    numbered = docs.withColumn("row", F.col("doc_id").cast("long"))
    if several.limit(1).count():
        # Numbers in the order of doc_id; the written table fixes them.
        order = ("doc_id", "text", "source", "lang", "n_chars")
        placed = docs.filter("doc_id is not null").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
        numbered = materialise(placed, "near-rows").unionByName(numbered.filter("doc_id is null"))
    found = ngram_join.ngram_components(numbered.select(F.col("row").alias("doc_id"), "text"), NEAR)
    gone = materialise(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("row")).distinct(), "near-gone")
    rows = numbered.join(gone, "row", "left_anti")
    once = Window.partitionBy("doc_id", text).orderBy("text", "source", "lang", "n_chars")
    # Null ids get keys of their own, as they are not one document.
    ranked = rows.filter("doc_id is not null").withColumn("copy", F.row_number().over(once)).filter("copy = 1").select(*COLUMNS)
    return ranked.unionByName(rows.filter("doc_id is null").select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: each document is in the mix as often as the words taken of it cover its size, to the nearest whole number."""
    name = F.md5(F.coalesce(F.col("text"), F.lit("")))
    taken = mixing.mix_documents(docs.withColumn("name", name), keep=("source", "name")).groupBy("doc_id", "source", "name").agg(
        (F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))).alias("share")
    )
    times = F.floor(F.col("share") + 0.5).cast("int")
    d, t = docs.select(*COLUMNS, name.alias("name")).alias("d"), taken.select("doc_id", "source", "name", times.alias("times")).filter("times > 0").alias("t")
    same = F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")) & F.col("d.source").eqNullSafe(F.col("t.source")) & (F.col("d.name") == F.col("t.name"))
    return d.join(t, same).select(*[F.col(f"d.{c}") for c in COLUMNS], F.explode(F.sequence(F.lit(1), F.col("t.times"))).alias("copy")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: token counts and digests of every document in the mix."""
    return sentencepiece_bpe.encode_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mix),
    ("SentencePiece encoding", encode),
]

#: The last stage has no SQL form; tests compare the whole pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written and read back as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
