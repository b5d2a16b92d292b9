"""Interleave sources to target weights by Pfair scheduling.

The documents of a source are numbered and cut into blocks. A source with weight w may place
its block k no earlier than slot floor(k / w) and has to by slot ceil((k + 1) / w); among the
blocks that may be placed the one with the earliest deadline goes first. Then at every slot
each source has placed its share of the slots to within less than one block.

Windows come from the weights as they are given, in whole numbers, over all slots: nothing is
rounded, so nothing adds up. When a source has no blocks left, the weights of the others are
scaled up. That is what a fluid would do that every source sends in proportion to its weight:
at the level V a source has sent min(V * w, its blocks), the slot is the sum of that over all
sources, and the window of a block is the part of it in which the fluid sends the block. One
task lays out the slots, a step for each block, and hands them out as it goes.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import cmp_to_key

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import released, stored, tasks_for

BLOCK_DOCS = 16
SLOTS_AT_ONCE = 1 << 16  # rows of a batch of the schedule
TEMPERATURE = 0.5  # without given weights, the power of a source's documents
NUMBERED_AT_ONCE = 4_000  # documents that a task numbers, about
DOCS_OF_A_FILE = 4_000  # documents in a file of the mixed table, about
ROWS_OF_A_KEY = 4_096  # rows of one key that are numbered together


def exact_schedule(blocks: list[int], weights: list[float]) -> Iterator[tuple[int, int]]:
    """For slot 0, 1, ... the place of its source in the list and the number of its block.

    At the end of each slot the source has placed its part of the fluid to within less than one
    block: windows hold no more blocks than slots, so earliest deadline first meets them all.
    """
    exact = [Fraction(w) for w in weights]
    scale = max((w.denominator for w in exact), default=1)  # powers of two, as of all floats
    whole = [int(w * scale) for w in exact]
    active = [x for x in range(len(blocks)) if blocks[x] > 0]

    def ends_before(x: int, y: int) -> int:
        return blocks[x] * whole[y] - blocks[y] * whole[x]

    # Sources by the level at which they are used up; blocks used up and weight left from then on.
    ends = sorted(active, key=cmp_to_key(ends_before))
    used, left = [0], [sum(whole[x] for x in active)]
    for x in ends:
        used.append(used[-1] + blocks[x])
        left.append(left[-1] - whole[x])

    def slot_at(x: int, k: int) -> tuple[int, bool]:
        """Slot, rounded down, in which the fluid has sent k blocks; whether it was rounded."""
        low, high = 0, len(ends)  # sources used up below the level k / whole[x]
        while low < high:
            at = (low + high) // 2
            if blocks[ends[at]] * whole[x] < k * whole[ends[at]]:
                low = at + 1
            else:
                high = at
        slot, rest = divmod(k * left[low], whole[x])
        return used[low] + slot, rest > 0

    # Of each source only the next block is in either heap.
    waiting = [(0, x, 0) for x in active]
    ready: list = []
    slot = 0
    while waiting or ready:
        while waiting and waiting[0][0] <= slot:
            _, x, k = heapq.heappop(waiting)
            release, part = slot_at(x, k + 1)
            heapq.heappush(ready, (release + part, x, k, release))
        _, x, k, release = heapq.heappop(ready)
        yield x, k
        slot += 1
        if k + 1 < blocks[x]:
            heapq.heappush(waiting, (release, x, k + 1))


def laid_out(sources: DataFrame) -> DataFrame:
    """``s``, ``block`` and ``slot`` of every block, of ``s``, ``blocks`` and ``weight`` of every source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns))]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or ""))
        names = pa.array([r[0] for r in rows], pa.string())
        steps = exact_schedule([r[1] for r in rows], [r[2] for r in rows])
        first = 0
        while part := list(itertools.islice(steps, SLOTS_AT_ONCE)):
            slots = pa.array(range(first, first + len(part)), pa.int64())
            own, blocks = (pa.array(c, pa.int64()) for c in zip(*part))
            yield pa.RecordBatch.from_arrays([names.take(own), blocks, slots], ["s", "block", "slot"])
            first += len(part)

    return sources.coalesce(1).mapInArrow(released(run), "s string, block long, slot long")


def numbered(docs: DataFrame, total: int) -> DataFrame:
    """Rows of ``__source`` and ``__key`` with ``__n``, the place of each in its source in the
    order of a hash, and ``__turn``, its place among the rows of its key.

    Rows of one key are folded to a count, in parts of ``ROWS_OF_A_KEY`` at most that hash
    differently, so a key that a third of the rows has is dealt like all others. Ranges of hash
    values are numbered on their own and shifted by the rows before them, so no task sees a
    whole source.
    """
    ranges = tasks_for(total, NUMBERED_AT_ONCE) * 2
    folded = docs.groupBy("__source", "__key").agg(F.count(F.lit(1)).alias("__all"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("__all") - 1, F.lit(ROWS_OF_A_KEY).cast("long"))
    parts = folded.select("__source", "__key", "__all", F.explode(starts).alias("__part"))
    parts = parts.withColumn("__rows", F.least(F.col("__all") - F.col("__part"), F.lit(ROWS_OF_A_KEY)))
    hashed = parts.withColumn("__hash", F.xxhash64("__key", "__part")).withColumn(
        "__range", F.floor((F.col("__hash") / F.lit(2.0**64) + 0.5) * ranges).cast("long")
    )
    counts = hashed.groupBy("__source", "__range").agg(F.sum("__rows").alias("__rows"))
    before = Window.partitionBy("__source").orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = counts.select(
        "__source", "__range", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("__source", "__range").orderBy("__hash", "__key", "__part")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        hashed.withColumn("__in", F.coalesce(F.sum("__rows").over(inside), F.lit(0)))
        .join(shifts, [hashed["__source"].eqNullSafe(shifts["__source"]), hashed["__range"] == shifts["__range"]])
        .drop(shifts["__source"])
        .drop(shifts["__range"])
        .withColumn("__first", F.col("__before") + F.col("__in"))
    )
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rows") - 1)).alias("__step")
    each = placed.select("__source", "__key", "__first", "__part", every)
    return each.select(
        "__source",
        "__key",
        (F.col("__first") + F.col("__step")).alias("__n"),
        (F.col("__part") + F.col("__step")).alias("__turn"),
    )


def _placed(
    picked: DataFrame, weights: Mapping[str | None, float] | None, block_docs: int
) -> DataFrame:
    """``__source``, ``__key``, ``__turn``, ``slot`` and ``position`` of every row of ``__source``
    and ``__key``."""
    sources = stored(picked.groupBy("__source").agg(F.count(F.lit(1)).alias("rows")))
    if weights is None:
        weighted = sources.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(TEMPERATURE)))
    else:
        given = picked.sparkSession.createDataFrame(
            [(name, float(w)) for name, w in weights.items()], "name string, weight double"
        )
        weighted = sources.join(given, sources["__source"].eqNullSafe(given["name"]), "left")
    lacking = weighted.where(~F.coalesce(F.col("weight") > 0, F.lit(False))).limit(5).collect()
    if lacking:
        raise ValueError(f"no weight for {[r['__source'] for r in lacking]}")
    total = sources.agg(F.sum("rows")).first()[0] or 0
    blocks = F.ceil(F.col("rows") / F.lit(block_docs)).cast("long")
    table = stored(laid_out(weighted.select(F.col("__source").alias("s"), blocks.alias("blocks"), "weight")))
    n = numbered(picked, total).withColumn("__block", F.floor(F.col("__n") / block_docs))
    placed = n.join(table, n["__source"].eqNullSafe(table["s"]) & (n["__block"] == table["block"]))
    position = F.col("slot") * block_docs + F.col("__n") % block_docs
    return placed.select("__source", "__key", "__turn", "slot", position.cast("long").alias("position"))


def positions(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block_docs: int = BLOCK_DOCS,
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``doc_id``, ``source``, ``slot`` (place of the block) and ``position`` of every row.

    ``position`` is ``slot * block_docs`` plus the place in the block: unique, and in order of
    the mixture, with gaps where a source's last block is not full. NULL is a source of its
    own. Rows with equal ids, or with NULL as id, are all placed, in any order among themselves.
    ``weights`` has a positive weight for every source of ``docs`` (one more is ignored, one
    missing is an error); without it a source has the weight of its number of rows to the power
    of ``TEMPERATURE``. Any number of sources can be mixed; the task that lays out the slots holds
    a few numbers of each. An empty table has no rows. Other columns are not read.
    """
    picked = docs.select(F.col(source).alias("__source"), F.col(doc_id).alias("__key"))
    return _placed(picked, weights, block_docs).select(
        F.col("__key").alias("doc_id"), F.col("__source").alias("source"), "slot", "position"
    )


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """``docs``, all rows and columns, as a table whose files are in the order of the mixture.

    The place of a row is that of its id. Rows that share an id, or have none, are told apart by
    128 bits of a hash of all their columns, and take the places of the id in the order of that
    hash; rows that are equal in everything take theirs in any order. An empty table stays one.
    """
    picked = docs.select(F.col("source").alias("__source"), F.col("doc_id").alias("__key"))
    # A row's source and id have the places of that source and id.
    own = F.struct("__source", "__key")
    order = _placed(picked, weights, BLOCK_DOCS).select(
        own.alias("__own"), "__turn", F.col("position").alias("__position")
    )
    order = stored(order)
    total = order.count()
    files = tasks_for(total, DOCS_OF_A_FILE)
    keyed = docs.withColumn("__mine", F.struct(F.col("source").alias("__source"), F.col("doc_id").alias("__key")))
    if not order.where("__turn > 0").limit(1).count():
        rows, on = keyed, keyed["__mine"] == order["__own"]
    else:
        row = F.struct(F.xxhash64(*docs.columns).alias("a"), F.xxhash64(F.lit(1), *docs.columns).alias("b"))
        keyed = keyed.withColumn("__row", row)
        turns = numbered(keyed.select(F.col("__mine").alias("__source"), F.col("__row").alias("__key")), total)
        turns = turns.select(F.col("__source").alias("__its"), F.col("__key").alias("__of"), F.col("__n").alias("__at"))
        order = order.join(turns, (order["__own"] == turns["__its"]) & (order["__turn"] == turns["__at"]))
        rows = keyed.dropDuplicates(docs.columns)  # one of equal rows meets all their places
        on = rows["__row"] == order["__of"]
    joined = rows.join(order, on)
    ordered = joined.repartitionByRange(files, "__position")
    return ordered.sortWithinPartitions("__position").select(*docs.columns)
