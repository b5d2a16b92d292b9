"""A corpus pipeline of five stages over the text operators.

Each stage takes (spark, docs, sf_dir), works on all documents that the one before kept, and
returns a DataFrame; ``run`` writes every result as Parquet below the shared folder and reads
it back as the next stage's documents. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import bpe, mixing, near_dup, perplexity, toxicity
from wayfare.llm.common import few, release, shared_path, ship, stored, table
from wayfare.llm.queries import ranks_path
from wayfare.operators.ranks import rows_before
from wayfare.sources.sinks import cleaned, remove

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOXIC_FROM = 0.7
SHINGLE, PERCENT = 5, 80


#: Rows that Spark sends to a Python worker at a time, where the session has its default: texts
#: are long, and a batch is held several times over.
BATCH_SETTING, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers, and keep their batches of texts small.

    What this process no longer uses, of earlier stages too, goes back to the system."""
    release()
    ship(spark)
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose perplexity is above what trusted text of their language has.

    A row is judged by itself: rows that repeat an id or a text, and rows with a NULL id, are
    judged like others. NULL and empty texts go; all others stay where nothing is labelled as
    trusted. An empty table stays empty; columns beyond those of ``documents`` are left out.
    """
    prepare(spark)
    judged = perplexity.judged_rows(docs, table(spark, sf_dir, "labels"), keep=tuple(COLUMNS))
    return judged.where("__kept").select(COLUMNS)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a toxicity of at least ``TOXIC_FROM``.

    Rows are judged one by one, as above. A NULL or empty text has the score of a text without
    features; without labels of both kinds all scores are the same. An empty table stays empty.
    """
    prepare(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select(COLUMNS), model, keep=tuple(COLUMNS))
    return scored.where(F.col("score") < TOXIC_FROM).select(COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keep the document with the least id.

    Rows with a NULL id or without words stay, and so do rows that share an id and are no near
    copies (see ``near_dup.deduplicated``). An empty table stays empty.
    """
    prepare(spark)
    return near_dup.deduplicated(docs.select(COLUMNS), SHINGLE, PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order that interleaves the sources by their target weights.

    Every row stays, those with a NULL or repeated id and NULL or empty texts too; NULL is a source
    of its own. The order is that of the files that are written. An empty table stays empty.
    """
    prepare(spark)
    return mixing.mixed(docs.select(COLUMNS))


def in_file_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``, the place of a row when files are read in the order they were
    written in; Spark itself reads large files first.

    ``docs`` must come straight from files. Spark numbers the files it writes; others are in the
    order of their names. The rows before each file are counted in ranges of files, by many tasks.
    """
    try:
        named = docs.withColumns({"__path": F.col("_metadata.file_path"), "__row": F.col("_metadata.row_index")})
    except AnalysisException as error:
        raise ValueError("the order of documents is known only when they are read from files") from error
    # Both numbers of a name like part-00003-(id)-c000.snappy.parquet, as text that sorts by them.
    name = F.element_at(F.split("__path", "/"), -1)
    numbers = [F.regexp_extract(name, rule, 1) for rule in (r"^part-(\d+)-", r"-c(\d+)\.")]
    ordered = F.concat(*[F.lpad(number, 12, "0") for number in numbers], F.col("__path"))
    named = named.withColumn("__file", ordered)
    before = stored(rows_before(named.select("__file"), "__file", [F.col("__file").asc()]))
    before = few(before.select(F.col("__file").alias("__of"), "__before"))
    placed = named.join(before, named["__file"] == before["__of"])
    return placed.select(*docs.columns, (F.col("__before") + F.col("__row")).alias("position"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; ``round_trip`` says that decoding gives the text again.

    ``position`` is the place of the document in ``docs``, which must be read from files: the
    order of the mixture. One row per input row, with NULL ids too; a NULL or empty text has no
    tokens. Columns beyond those of ``documents`` are not read.
    """
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    # A digest goes along instead of a second copy of the text.
    placed = in_file_order(docs.select(COLUMNS))
    marked = placed.select("doc_id", "source", "position", F.sha2(text, 256).alias("digest"), "text")
    done = bpe.coded(marked, ranks_path(), keep=("doc_id", "source", "position", "digest"))
    return done.select(
        "doc_id",
        "source",
        "position",
        "tokens",
        F.size("tokens").cast("long").alias("n_tokens"),
        (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("near-duplicates", near_dedup),
    ("source mixing", mix_sources),
    ("byte-level BPE", tokenize),
]

#: Model fits, hash families and merges are not SQL; the tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    Each result is written below the shared folder and read back. What a stage needed in between,
    and the result before it, are deleted when it is written.
    """
    docs = table(spark, sf_dir, "documents")
    folder = shared_path(spark)
    for number, (_, stage) in enumerate(STAGES):
        with cleaned(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            remove(spark, f"{folder}/{number - 1}")
    return docs
