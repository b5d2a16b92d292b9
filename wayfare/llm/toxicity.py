"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes ratios.

A feature is the presence of a character n-gram of the lower-cased text. Its value is the
log-count ratio of naive Bayes, the log of how much more often toxic documents have it; a
logistic regression is fitted on these values. Both are learned from a bounded sample of
labelled rows; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, held_out, release, released, texts

ORDERS = (3, 4, 5)
BUCKETS = 1 << 21
SAMPLE_OF_EACH = (2000, 4000)  # labelled rows to fit on: toxic, not toxic
SAMPLE_CHARS = 20_000  # longest text in that sample
LEAST_RATIO = 0.7  # features nearer to even odds than this are left out of the fit
LEAST_DOCS = 3
FITTED_AT_ONCE = 1 << 16  # characters whose features the fit works out together, or one text
MIXED = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one for each bucket; most are 0
    bias: float


def features(batch: list[str], wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text number, bucket), each once, sorted. ``wanted``: the buckets to report."""
    low = [x.lower() for x in batch]
    lengths = np.array([len(x) for x in low], np.int64)
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(low)), lengths)
    found, key = [], points
    for order in range(2, max(ORDERS) + 1):
        if len(points) < order:
            break
        key = key[: len(points) - order + 1] * MIXED + points[order - 1 :]
        if order in ORDERS:
            bucket = ((key ^ (key >> np.uint64(29))) * MIXED >> np.uint64(43)).astype(np.int64)
            inside = owner[: len(bucket)] == owner[order - 1 :]
            if wanted is not None:
                inside &= wanted[bucket]
            at = np.flatnonzero(inside)
            found.append(owner[at] * BUCKETS + bucket[at])
    both = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return both // BUCKETS, both % BUCKETS


def fit(batch: list[str], toxic: np.ndarray, rounds: int = 60) -> Model:
    """Ratios and weights from labelled texts. With one class only, every score is its rate."""
    weights = np.zeros(BUCKETS, np.float32)
    positives, negatives = int(toxic.sum()), int((1 - toxic).sum())
    if not positives or not negatives:
        return Model(weights, -8.0 if not positives else 8.0)
    ends = np.cumsum([len(x) + 1 for x in batch])
    together = []
    while (first := together[-1].stop if together else 0) < len(batch):
        fits = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + FITTED_AT_ONCE, "right"))
        together.append(slice(first, max(first + 1, fits)))
    counts = [np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)]
    for part in together:
        d, b = features(batch[part], None)
        marked = toxic[part][d]
        for k in (0, 1):
            np.add.at(counts[k], b[marked == k], 1)
    often = np.flatnonzero(counts[0] + counts[1] >= LEAST_DOCS)
    ratio = np.log((counts[1][often] + 1) / (positives + 2)) - np.log((counts[0][often] + 1) / (negatives + 2))
    del counts
    telling = np.abs(ratio) >= LEAST_RATIO
    columns, scale = often[telling], ratio[telling]
    del often, ratio, telling
    used = np.zeros(BUCKETS, bool)
    used[columns] = True
    # Features are worked out once more: those that are left out would take most of the memory.
    place = np.zeros(BUCKETS, np.int32)
    place[columns] = np.arange(len(columns), dtype=np.int32)
    parts = []
    for part in together:
        d, b = features(batch[part], used)
        parts.append((part, d.astype(np.uint16), place[b]))  # of at most 65,536 texts
    del place, used
    w, bias = np.zeros(len(columns)), 0.0
    m, v, mb, vb = np.zeros(len(columns)), np.zeros(len(columns)), 0.0, 0.0
    share = np.where(toxic == 1, 0.5 / positives, 0.5 / negatives)
    for step in range(1, rounds + 1):
        slope, total = np.zeros(len(columns)), 0.0
        scaled = scale * w
        for part, d, local in parts:
            score = np.bincount(d, scaled[local], part.stop - part.start) + bias
            error = (1 / (1 + np.exp(-np.clip(score, -40, 40))) - toxic[part]) * share[part]
            np.add.at(slope, local, error[d])
            total += error.sum()
        slope = slope * scale + 1e-4 * w
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        mb, vb = 0.9 * mb + 0.1 * total, 0.99 * vb + 0.01 * total**2
        rate = 0.05 / (1 - 0.9**step) * np.sqrt(1 - 0.99**step)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        bias -= rate * mb / (np.sqrt(vb) + 1e-8)
    weights[columns] = w * scale
    return Model(weights, float(bias))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most ``SAMPLE_OF_EACH`` labelled rows, none of them held out.

    They are those with the least hashes of their id. Texts that are empty or longer than
    ``SAMPLE_CHARS`` characters take no part, nor do rows with a NULL text, id or label. A
    document with several labels counts once for each.
    """
    marked = labels.select("doc_id", F.col("toxic").alias("__toxic")).where(
        F.col("__toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    usable = docs.select("doc_id", "text").where(F.length("text").between(1, SAMPLE_CHARS))
    ids = usable.select("doc_id").join(marked, "doc_id")
    batch: list[str] = []
    toxic: list[int] = []
    for label, bound in zip((1, 0), SAMPLE_OF_EACH):
        chosen = (
            ids.where(F.col("__toxic") == label)
            .select("doc_id")
            .distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(bound)
        )
        some = usable.join(F.broadcast(chosen), "doc_id")
        # Rows that repeat an id do not raise the bound; which take part does not depend on order.
        for row in some.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text").limit(bound).collect():
            batch.append(row["text"])
            toxic.append(label)
    model = fit(batch, np.array(toxic, np.int64))
    del batch, some
    release()  # the driver's process lives on
    return model


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep`` and ``score`` (0 to 1) for every row.

    An empty or NULL text has no features and gets the score of the bias alone. Repeated
    rows and NULL keys stay. Other columns are not read. The model's size is fixed
    (``BUCKETS``), so it is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value.weights, sent.value.bias
        wanted = weights != 0
        for batch in chunks(batches, "__text", 1 << 19):
            owner, bucket = features(texts(batch, "__text"), wanted)
            total = np.bincount(owner, weights[bucket], batch.num_rows) + bias
            out = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.float64())], [*keep, "score"]
            )

    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(released(run), f"{fields}, score double")


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, with a model learnt from
    ``labels`` (``doc_id`` and ``toxic``).

    Rows with a NULL or repeated id are scored like others; a NULL or empty text has the score of
    the bias alone, and a text of any length is scored whole. With labels of one kind, or none,
    all scores are equal. An empty table gives no rows. Other columns are not read.
    """
    return score(docs, learn(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
