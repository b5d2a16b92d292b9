"""Quality by perplexity under an interpolated modified Kneser-Ney model.

The model's n-grams are of bytes, so a key is exact in a 64-bit number and a context or
suffix of it is a shift or a mask. Counts of all trusted text are summed per key; lower
orders count distinct left neighbours, and each order has three discounts from its own counts
of counts. Count tables are sharded by key and joined order by order.

To score, documents are dealt into blocks. The distinct n-grams of each block are joined with
the sharded model, and a block's answers meet its documents again. A document is rejected
when its perplexity lies above what trusted text of its language and length has, a quantile of
held-out trusted documents plus a margin that is itself a distance of quantiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.llm.common import few, held_out, release, released, stored, tasks_for

ORDER = 4
BLOCK_CHARS = 8 << 20  # text of a block
MIDDLE, UPPER = 0.5, 0.99  # quantiles of log perplexity
ENOUGH = 100  # held-out trusted texts of a language from which its own quantiles hold alone
MARGIN = 0.5  # times the distance of the quantiles is allowed above the upper one
DISTANCE = 0.75  # times the distance of quantiles of log perplexity is allowed at any length
FEW_DISTANCE = 2.5  # the same where few texts leave the middle itself uncertain
START = 0x0A  # a text begins and ends with a line feed
SEEN, MISSING = 0, 256


def _keys(raw: bytes, order: int) -> np.ndarray:
    """The n-grams of a text as numbers, first byte highest, with line feeds around it."""
    data = np.frombuffer(bytes([START]) * (order - 1) + raw + bytes([START]), np.uint8).astype(np.int64)
    size = len(raw) + 1
    key = data[:size].copy()
    for j in range(1, order):
        key = key << 8 | data[j : size + j]
    return key


def _raws(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def counts(docs: DataFrame, order: int, text: str = "text") -> DataFrame:
    """``key`` and ``n`` of all n-grams: summed within tasks, then by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, waiting, size = np.empty(0, np.int64), np.empty(0, np.int64), [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            found, n = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (keys[:0], sums[:0])
            both = np.concatenate((keys, found))
            total, place = np.unique(both, return_inverse=True)
            return total, np.bincount(place, np.concatenate((sums, n)), len(total)).astype(np.int64)

        for batch in batches:
            for raw in _raws(batch, "__text"):
                if raw:
                    waiting.append(_keys(raw, order))
                    size += len(raw)
                if size > 2 << 20:
                    keys, sums = folded()
                    waiting, size = [], 0
        keys, sums = folded()
        for first in range(0, len(keys), 100_000):
            part = slice(first, first + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(keys[part]), pa.array(sums[part])], ["key", "n"])

    source = docs.select(F.col(text).alias("__text"))
    return source.mapInArrow(released(run), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def discounts(table: DataFrame) -> tuple[float, float, float]:
    """D1, D2 and D3+ from how many n-grams have the counts 1 to 4."""
    found = {r["n"]: r["k"] for r in table.where("n <= 4").groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect()}
    n1, n2, n3, n4 = (float(found.get(i, 0)) for i in (1, 2, 3, 4))
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else 2.0
    return min(max(d1, 0.05), 1.0), min(max(d2, 0.1), 2.0), min(max(d3, 0.1), 3.0)


def _context(key: str) -> Column:
    return F.shiftright(key, 8)


def _suffix(key: str, order: int) -> Column:
    """The n-gram without its first byte."""
    return F.col(key).bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1).cast("long"))


def fit(trusted: DataFrame, order: int = ORDER, text: str = "text") -> list[tuple[DataFrame, DataFrame]]:
    """For each order, 1 first: ``key`` and ``p`` of seen n-grams, ``context`` and ``gamma``."""
    tables = {order: stored(counts(trusted, order, text))}
    for k in range(order - 1, 0, -1):
        tables[k] = stored(
            tables[k + 1].groupBy(_suffix("key", k + 1).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        )
    model, lower = [], None
    for k in range(1, order + 1):
        d1, d2, d3 = discounts(tables[k])
        d = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        counted = tables[k].select("key", "n", _context("key").alias("context"), d.alias("d"))
        totals = counted.groupBy("context").agg(
            F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("gamma")
        )
        joined = counted.join(totals, "context")
        if lower is None:
            below = F.lit(1.0 / 256)
        else:
            joined = joined.withColumn("lower_key", _suffix("key", k)).join(
                lower.select(F.col("key").alias("lower_key"), F.col("p").alias("lower_p")), "lower_key"
            )
            below = F.col("lower_p")
        p = F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("gamma") * below
        lower = stored(joined.select("key", p.alias("p")))
        model.append((lower, stored(totals.select("context", "gamma"))))
    return model


def log_probabilities(keys: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``key`` and ``logp`` of distinct n-grams, seen or not: two joins an order.

    The probability is that of the longest suffix that was seen, times the weights of the
    contexts that were longer.
    """
    found = keys
    logp, weight, part = None, F.lit(0.0), F.col("key")
    for k in range(len(model), 0, -1):
        seen, contexts = model[k - 1]
        found = found.withColumn("__part", part).join(
            seen.select(F.col("key").alias("__part"), F.col("p").alias(f"p{k}")), "__part", "left"
        )
        found = found.drop("__part").withColumn("__context", F.shiftright(part, 8)).join(
            contexts.select(F.col("context").alias("__context"), F.col("gamma").alias(f"gamma{k}")),
            "__context",
            "left",
        ).drop("__context")
        own = (F.col(f"p{k}").isNotNull(), F.log(f"p{k}") + weight)
        logp = F.when(*own) if logp is None else logp.when(*own)
        weight = weight + F.coalesce(F.log(f"gamma{k}"), F.lit(0.0))
        part = F.col("key").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1).cast("long"))
    return found.select("key", logp.otherwise(weight - F.log(F.lit(256.0))).alias("logp"))


def scored(
    docs: DataFrame,
    model: list[tuple[DataFrame, DataFrame]],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id", "lang"),
) -> DataFrame:
    """Columns ``keep``, ``n_bytes`` and ``log_p`` (sum over the n-grams) of every row."""
    order = len(model)
    picked = docs.select(*keep, F.col(text).alias("__text"))
    total = picked.agg(F.sum(F.length("__text"))).first()[0] or 0
    blocks = tasks_for(total, BLOCK_CHARS)
    names = picked.columns
    dealt = picked.withColumn("block", F.pmod(F.xxhash64(*names), F.lit(blocks)).cast("int"))
    dealt = dealt.repartition(blocks, "block")

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition may hold several blocks; they are kept apart.
        found: dict[int, np.ndarray] = {}
        waiting: dict[int, list[np.ndarray]] = {}
        sizes: dict[int, int] = {}

        def fold(block: int) -> None:
            found[block] = np.unique(np.concatenate([found.get(block, np.empty(0, np.int64)), *waiting.pop(block)]))
            sizes[block] = 0

        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), _raws(batch, "__text")):
                waiting.setdefault(block, []).append(_keys(raw, order))
                sizes[block] = sizes.get(block, 0) + len(raw)
                if sizes[block] > 2 << 20:
                    fold(block)
        for block in list(waiting):
            fold(block)
        for block, keys in found.items():
            for first in range(0, len(keys), 100_000):
                part = keys[first : first + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), block, np.int32)), pa.array(part)], ["block", "key"]
                )

    # One plan: the text is shuffled once and read by both steps, and so are the n-grams.
    shards = max(blocks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Neither column can be NULL: no filter gets between the steps, which would undo that.
    pairs = T.StructType(
        [T.StructField("block", T.IntegerType(), False), T.StructField("key", T.LongType(), False)]
    )
    asked = dealt.mapInArrow(released(distinct), pairs).repartition(shards, "key")
    answers = log_probabilities(asked.select("key").distinct(), model)
    replies = asked.join(answers, "key")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema[:-1])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = right.column("key").to_numpy()
        by = np.argsort(keys)
        keys, logs = keys[by], right.column("logp").to_numpy()[by]
        sizes, sums = [], []
        for raw in left.column("__text").cast(pa.binary()).to_pylist():
            raw = raw or b""
            own = np.sort(_keys(raw, order))
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            n = np.diff(np.append(first, len(own)))
            sums.append(float((logs[np.searchsorted(keys, own[first])] * n).sum()))
            sizes.append(len(raw))
        columns = [left.column(c) for c in keep]
        del keys, logs, by
        release()
        return pa.table(
            [*columns, pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())],
            names=[*keep, "n_bytes", "log_p"],
        )

    return (
        dealt.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(score, f"{fields}, n_bytes bigint, log_p double")
    )


def limits(trusted: DataFrame) -> DataFrame:
    """For each language and for all (NULL): the middle log perplexity, the highest ``surprise``
    kept, and the ``distance`` above the middle that is kept at any length.

    The surprise of a text is its distance above the middle times the root of its length: long
    texts come closer to the middle than short ones. The limit is its upper quantile and a part
    of the distance of quantiles. As topics differ however long a text is, a part of the same
    distance of plain log perplexities is allowed as well.

    A language with fewer than ``ENOUGH`` texts says little about its middle and spread: its limits
    are not below those that texts of all languages have about the middles of their own, and a
    larger distance is allowed.

    Values are rounded: then the mergeable sketches of ``percentile_approx`` have room for every
    value that occurs, and the quantiles are exact and repeatable.
    """
    value = F.round(-F.col("log_p") / (F.col("n_bytes") + 1), 3)
    root = F.sqrt(F.col("n_bytes") + 1)
    each = trusted.where("n_bytes > 0").select("lang", value.alias("v"), root.alias("root"))
    both = each.where("lang is not null").withColumn("of", F.col("lang")).unionByName(
        each.withColumn("of", F.lit(None).cast("string"))
    )

    def quantiles(column: str) -> Column:
        return F.percentile_approx(column, [MIDDLE, UPPER], 10_000)

    def spread(q: str) -> Column:
        return F.col(q)[1] - F.col(q)[0]

    plain = both.groupBy("of").agg(quantiles("v").alias("q"), F.count(F.lit(1)).alias("texts"))
    plain = plain.select("of", "texts", F.col("q")[0].alias("middle"), spread("q").alias("apart"))
    known = F.broadcast(plain.select(F.col("of").alias("__of"), "middle"))  # a row for each language
    away = both.join(known, F.col("of").eqNullSafe(F.col("__of"))).withColumn("away", F.col("v") - F.col("middle"))
    away = away.withColumn("surprise", F.round(F.col("away") * F.col("root"), 2))
    high = (F.col("s")[1] + MARGIN * spread("s")).alias("high")
    own = away.groupBy("of").agg(quantiles("surprise").alias("s")).select(F.col("of").alias("__own"), high)
    pooled = (
        away.where("of is not null")
        .agg(quantiles("surprise").alias("s"), F.percentile_approx(F.round("away", 3), UPPER, 10_000).alias("all_apart"))
        .select(high.alias("all_high"), "all_apart")
    )
    found = plain.join(own, F.col("of").eqNullSafe(F.col("__own"))).crossJoin(F.broadcast(pooled))
    few_texts = F.col("of").isNotNull() & (F.col("texts") < ENOUGH)
    return found.select(
        "of",
        "middle",
        F.when(few_texts, F.greatest("high", "all_high")).otherwise(F.col("high")).alias("surprise"),
        F.when(few_texts, FEW_DISTANCE * F.greatest("apart", "all_apart"))
        .otherwise(DISTANCE * F.col("apart"))
        .alias("distance"),
    )


def judged_rows(
    docs: DataFrame,
    labels: DataFrame,
    order: int = ORDER,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id", "lang"),
) -> DataFrame:
    """Columns ``keep`` (``doc_id`` and ``lang`` among them), ``__bytes``, ``__log`` (minus the
    mean log probability of a byte) and ``__kept`` of every row; see ``judge``."""
    # The ids are small, so the text is not shuffled to find what is trusted.
    good = few(labels.where(F.col("quality") == 1).select("doc_id").distinct())
    trusted = docs.select("doc_id", F.col(text).alias("text")).join(good, "doc_id", "left_semi")
    model = fit(trusted.where(~held_out(F.col("doc_id"))), order)
    found = stored(scored(docs, model, text, keep))
    bounds = limits(found.where(held_out(F.col("doc_id"))).join(good, "doc_id", "left_semi"))
    names = ("middle", "surprise", "distance")
    rows = [(r["of"], *[float(r[x]) for x in names]) for r in bounds.collect()]  # one a language
    table = docs.sparkSession.createDataFrame(rows, "__of string, __middle double, __surprise double, __distance double")
    every = dict(zip(names, next((r[1:] for r in rows if r[0] is None), (0.0, float("inf"), float("inf")))))
    own = found.join(
        F.broadcast(table.where("__of is not null")), F.col("lang") == F.col("__of"), "left"
    )
    middle, surprise, distance = (F.coalesce(F.col(f"__{x}"), F.lit(every[x])) for x in names)
    size = F.col("n_bytes") + 1
    log = -F.col("log_p") / size
    allowed = F.greatest(surprise / F.sqrt(size), distance)
    return own.select(
        *keep,
        F.col("n_bytes").alias("__bytes"),
        log.alias("__log"),
        ((F.col("n_bytes") > 0) & (log - middle <= allowed)).alias("__kept"),
    )


def judge(docs: DataFrame, labels: DataFrame, order: int = ORDER, text: str = "text") -> DataFrame:
    """``doc_id``, ``lang``, ``n_bytes``, ``perplexity`` (of a byte) and ``kept`` of every row.

    Trusted are the texts whose label ``quality`` is 1; those that are held out do not count
    in the model but give the quantiles. A text may be the further above the middle of its
    language the shorter it is (see ``limits``), so a few odd words do not reject a short text,
    and a long one that is odd throughout does not pass. An empty or NULL text has perplexity
    NULL and is not kept. A language without held-out trusted text, or NULL, takes the quantiles
    over all languages, and one with fewer than ``ENOUGH`` such texts has at least the limits of
    texts of all languages about the middles of their own; without any trusted text every
    non-empty text is kept. Repeated rows and NULL ids stay. Other columns are not read, whatever
    their names. An empty table has no rows.
    """
    return judged_rows(docs, labels, order, text).select(
        "doc_id",
        "lang",
        F.col("__bytes").alias("n_bytes"),
        F.when(F.col("__bytes") > 0, F.exp("__log")).alias("perplexity"),
        F.col("__kept").alias("kept"),
    )
