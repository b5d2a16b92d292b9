"""Language by compression: the language whose sample text helps zstandard most.

Each language has a raw-content dictionary of sample text. A text is cut into blocks (whole,
no part is left out), each block is compressed with each dictionary, and the language with
the smallest sum is chosen. If the runner-up is nearly as small, the choice is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, held_out, released, texts

SAMPLE_DOCS = 300  # documents of each language that a dictionary is made from
MOST_LANGUAGES = 500  # languages that are learnt
SAMPLE_PARTS = 16  # parts of a language that are searched for its sample
SAMPLE_CHARS = 1_000  # longest piece of one of them
DICTIONARY_BYTES = 112 << 10
BLOCK_BYTES = 8 << 10
LEVEL = 6
LEAST_MARGIN = 0.01  # share by which the smallest must be below the second
SURE_MARGIN = 0.15  # margin that counts as certain
NO_LANGUAGE = "und"


def learn(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries, in order of how many rows their language has, from a bounded sample of
    the rows that are not held out.

    Rows with NULL in id, language or text take no part. The sample of a language is the
    ``SAMPLE_DOCS`` documents whose ids have the least hashes; a middle piece of at most
    ``SAMPLE_CHARS`` characters of each goes into the dictionary. The ``MOST_LANGUAGES`` languages
    with the most rows are learnt.
    """
    usable = docs.select("doc_id", "lang", "text").where(
        F.col("lang").isNotNull()
        & F.col("doc_id").isNotNull()
        & (F.length("text") > 0)
        & ~held_out(F.col("doc_id"))
    )
    # Each language has a dictionary of up to ``DICTIONARY_BYTES`` on the driver and in each task.
    common = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = {row["lang"]: row["count"] for row in common.collect()}
    usable = usable.where(F.col("lang").isin(list(counts)))
    first = F.greatest(F.lit(1), ((F.length("text") - SAMPLE_CHARS) / 2).cast("int"))
    # The least hashes of ids, in two steps, so that no task gets all ids of a language.
    ids = usable.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).distinct()
    for keys in (["lang", F.pmod(F.col("h"), F.lit(SAMPLE_PARTS))], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("h", "doc_id")
        ids = ids.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
    pieces = usable.select(
        "doc_id", "lang", F.substring("text", first, F.lit(SAMPLE_CHARS)).alias("piece")
    )
    chosen = pieces.join(F.broadcast(ids.select("lang", "doc_id", "n")), ["lang", "doc_id"])
    # Of rows that share an id one takes part, so a language has ``SAMPLE_DOCS`` pieces at most.
    rows = chosen.groupBy("lang", "n").agg(F.min("piece").alias("piece")).collect()
    found: dict[str, list[tuple[int, str]]] = {}
    for row in rows:
        found.setdefault(row["lang"], []).append((row["n"], row["piece"]))
    return {
        lang: "\n".join(x.lower() for _, x in sorted(found[lang])).encode()[-DICTIONARY_BYTES:]
        for lang in sorted(found, key=lambda x: (-counts[x], x))
    }


@lru_cache(maxsize=1)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[zstandard.ZstdCompressor]:
    made = []
    for _, sample in model:
        data = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
            )
        )
    return made


def sizes(text: str, compressors: list[zstandard.ZstdCompressor]) -> list[int]:
    """Compressed bytes of the whole lower-cased text with each dictionary."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
    return [sum(len(c.compress(b)) for b in blocks) for c in compressors]


def predict(
    docs: DataFrame,
    model: dict[str, bytes],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Columns ``keep``, ``lang_pred``, ``score`` (0 to 1, from the margin) and ``rejected``.

    A NULL text, one without a letter, and every text under an empty model get ``und``, 0
    and true. Of equal sizes the more frequent language is chosen, with score 0. Repeated
    rows and NULL keys stay. The model has ``DICTIONARY_BYTES`` for a language at most.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [name for name, _ in sent.value]
        compressors = _compressors(sent.value)
        for batch in chunks(batches, "__text"):
            langs, scores, rejected = [], [], []
            for value in texts(batch, "__text"):
                if not names or not any(map(str.isalpha, value)):
                    langs.append(NO_LANGUAGE)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                found = np.array(sizes(value, compressors))
                best = int(found.argmin())
                others = np.delete(found, best)
                margin = 1 - found[best] / others.min() if len(others) else 1.0
                langs.append(names[best])
                scores.append(float(min(1.0, margin / SURE_MARGIN)))
                rejected.append(bool(margin < LEAST_MARGIN))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                [*keep, "lang_pred", "score", "rejected"],
            )

    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(released(run), f"{fields}, lang_pred string, score double, rejected boolean")


def predictions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``rejected`` of every row, with
    dictionaries learnt from ``docs`` (see ``learn`` and ``predict``).

    Rows with a NULL or repeated id, or without a language, are predicted like others; NULL texts
    and those without a letter are ``und``. An empty table gives no rows. Other columns are not
    read.
    """
    return predict(docs, learn(docs)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )
