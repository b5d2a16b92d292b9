"""Exact top-k by inner product with M-trees.

Inner products become distances: with one more component, the root of what its norm lacks to
the largest norm, every vector has the same length, and the nearest vectors to a query are
those with the largest products. The vectors are dealt into blocks by the nearest of some
pivots, and a query visits the blocks that its bound and their covering radii leave. A task builds
the M-tree of a block: pages of at most ``PAGE`` entries, each with a routing vector, its
covering radius, and the distances of the entries to it. Queries, also in blocks, search the
tree best first: pages in the order of the least distance they can hold, until that exceeds
the k-th best found. Entries whose stored distance to the routing vector differs too much
from the query's are skipped without computing a product. The best of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from wayfare.llm.common import released, stored, tasks_for

SCALE = 64  # fixed value of the contract, as are the next two
QUERY_STEP = 20
TOP = 20
PAGE = 128
BLOCK = 1 << 13  # vectors of a tree
QUERY_BLOCK = 1 << 14  # queries that search a tree together
QUERIES_AT_ONCE = 1 << 11
MOST_PIVOTS = 2_048  # pivots are on the driver and in each task
LARGEST = 1 << 18  # vectors with larger components are compared apart from the trees
SLACK = 1e-6


@dataclass
class Leaf:
    router: int  # an entry of the tree; the page's routing vector
    radius: float
    entries: np.ndarray  # sorted by their distance to the router
    distances: np.ndarray


class Tree:
    """Pages over the rows of ``vectors`` (whole numbers)."""

    def __init__(self, vectors: np.ndarray, page: int = PAGE, longest: float | None = None) -> None:
        self.vectors = vectors.astype(np.float64)  # products of whole numbers stay exact
        norms = (self.vectors**2).sum(1)
        self.longest = float(norms.max(initial=0.0)) if longest is None else longest
        self.rest = np.sqrt(self.longest - norms)
        self.pages: list[Leaf] = []
        #: Inner pages: a router, its radius, and the pages below it.
        self.inner: list[tuple[int, float, list[int]]] = []
        todo = [np.arange(len(vectors))]
        while todo:
            rows = todo.pop()
            if len(rows) <= page:
                if len(rows):
                    self._leaf(rows)
                continue
            ways = min(page, -(-len(rows) * 2 // page))
            routers = rows[np.linspace(0, len(rows) - 1, ways).astype(int)]
            nearest = self._squares(rows, routers).argmin(1)
            parts = [rows[nearest == k] for k in range(ways)]
            if max(map(len, parts)) == len(rows):  # equal vectors: cut anywhere
                parts = np.array_split(rows, -(-len(rows) // page))
            todo += [part for part in parts if len(part)]
        self._group()

    def _squares(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        products = self.vectors[rows] @ self.vectors[others].T
        products += self.rest[rows][:, None] * self.rest[others][None, :]
        return np.maximum(2 * self.longest - 2 * products, 0.0)

    def _leaf(self, rows: np.ndarray) -> None:
        every = np.sqrt(self._squares(rows, rows))
        router = int(every.max(1).argmin())  # the entry with the smallest covering radius
        distances = every[router]
        order = np.argsort(distances, kind="stable")
        self.pages.append(Leaf(int(rows[router]), float(distances.max()), rows[order], distances[order]))

    def _group(self) -> None:
        """One more level: pages under routers of their own, with a radius that covers them."""
        routers = np.array([p.router for p in self.pages], int)
        if not len(routers):
            return
        picks = routers[:: max(1, int(len(routers) ** 0.5))]
        squares = np.sqrt(self._squares(routers, picks))
        nearest = squares.argmin(1)
        for k, pick in enumerate(picks):
            below = np.flatnonzero(nearest == k)
            if len(below):
                radius = max(squares[i, k] + self.pages[i].radius for i in below)
                self.inner.append((int(pick), float(radius), below.tolist()))

    def search(
        self, queries: np.ndarray, own: np.ndarray, top: int, least: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and products of the best ``top`` for each query, ties to the smaller row
        (-1 where there are fewer), and how many products were computed.

        ``own``: a row that each query must not get, or -1; give more by masking afterwards.
        ``least``: products below it need not be found (minus infinity for none).
        """
        q = queries.astype(np.float64)
        size, shift = len(q), len(self.vectors)
        best = np.full((size, top), np.iinfo(np.int64).min, np.int64)  # product and row in one
        base = (q**2).sum(1) + self.longest
        # Distance within which an entry may still count.
        reach = np.full(size, np.inf) if least is None else np.sqrt(np.maximum(base - 2.0 * least, 0.0))
        computed = 0
        # Lower bounds of the pages: through the inner page and through their own router.
        bounds = np.zeros((size, len(self.pages)))
        for pick, radius, below in self.inner:
            away = np.sqrt(np.maximum(base - 2 * (q @ self.vectors[pick]), 0.0)) - radius
            bounds[:, below] = np.maximum(bounds[:, below], away[:, None])
        # A page's router is asked only if the inner page above it may hold something.
        may = np.flatnonzero((bounds <= (reach * (1 + SLACK) + SLACK)[:, None]).any(0))
        to_router = np.full(bounds.shape, np.inf)
        routers = np.array([self.pages[i].router for i in may], int)
        to_router[:, may] = np.sqrt(np.maximum(base[:, None] - 2 * (q @ self.vectors[routers].T), 0.0))
        computed += size * (len(may) + len(self.inner))
        radii = np.array([p.radius for p in self.pages])
        bounds = np.maximum(bounds, to_router - radii[None, :])
        order = np.argsort(bounds, 1, kind="stable")
        live = np.arange(size)
        for turn in range(len(self.pages)):
            page_of = order[live, turn]
            more = bounds[live, page_of] <= reach[live] * (1 + SLACK) + SLACK
            live, page_of = live[more], page_of[more]
            if not len(live):
                break
            by = np.argsort(page_of, kind="stable")
            cuts = np.flatnonzero(np.diff(page_of[by])) + 1
            for group in np.split(by, cuts):
                rows, page = live[group], self.pages[page_of[group[0]]]
                near = to_router[rows, page_of[group[0]]]
                limit = reach[rows] * (1 + SLACK) + SLACK
                first = np.searchsorted(page.distances, (near - limit).min(), "left")
                last = np.searchsorted(page.distances, (near + limit).max(), "right")
                entries = page.entries[first:last]
                if not len(entries):
                    continue
                products = (q[rows] @ self.vectors[entries].T).astype(np.int64)
                computed += products.size
                keys = products * shift + (shift - 1 - entries)[None, :]
                keys[entries[None, :] == own[rows][:, None]] = np.iinfo(np.int64).min
                both = np.concatenate((best[rows], keys), 1)
                both = np.partition(both, both.shape[1] - top, 1)[:, -top:]
                best[rows] = both
                worst = both.min(1)
                full = worst > np.iinfo(np.int64).min
                score = worst // shift
                nearer = np.sqrt(np.maximum(base[rows[full]] - 2.0 * score[full], 0.0))
                reach[rows[full]] = np.minimum(reach[rows[full]], nearer)
        best = -np.sort(-best, 1)
        none = best == np.iinfo(np.int64).min
        found = np.where(none, -1, shift - 1 - best % shift)
        return found, np.where(none, 0, best // shift), computed


def whole_numbers(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id`` and floor(64 x) of each component, of the vectors that take part: in ``v``, or, for
    vectors with a component beyond ``LARGEST``, the components as they are in ``wide``."""
    finite = F.forall(
        F.col(embedding),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    large = F.exists(F.col(embedding), lambda x: F.abs(x.cast("double")) >= F.lit(LARGEST / SCALE))
    valid = F.col(embedding).isNotNull() & finite & F.col(vec_id).isNotNull()
    bound = F.lit(LARGEST / SCALE)  # only so that the branch not taken has no overflow
    narrow = F.transform(
        F.col(embedding),
        lambda x: F.floor(F.greatest(-bound, F.least(bound, x.cast("double"))) * SCALE).cast("int"),
    )
    return vectors.where(valid).select(
        F.col(vec_id).cast("long").alias("id"),
        F.when(~large, narrow).alias("v"),
        F.when(large, F.col(embedding).cast("array<double>")).alias("wide"),
    )


DIGIT = 17  # bits: products of digits of vectors up to 2^19 long are exact as floats


def _wide_number(x: float) -> int:
    """floor(64 x) modulo 2^64, as a signed number."""
    number = int(x) * SCALE if abs(x) >= 1 << 53 else floor(x * SCALE)
    return (number + (1 << 63)) % (1 << 64) - (1 << 63)


def exact_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows of any 64-bit numbers, modulo 2^64: exact if they fit.

    Numbers are cut into signed digits, whose products are exact as floats; 64-bit sums wrap.
    """
    digits = []
    for matrix in (left, right):
        rest, parts = matrix.astype(np.int64), []
        while len(parts) < 4:
            low = ((rest + (1 << (DIGIT - 1))) & ((1 << DIGIT) - 1)) - (1 << (DIGIT - 1))
            parts.append(low.astype(np.float64))
            rest = (rest - low) >> DIGIT
        digits.append(parts)
    total = np.zeros((len(left), len(right)), np.uint64)
    for i, one in enumerate(digits[0]):
        for j, two in enumerate(digits[1]):
            if DIGIT * (i + j) < 64 and one.any() and two.any():
                total += (one @ two.T).astype(np.int64).astype(np.uint64) << np.uint64(DIGIT * (i + j))
    return total.view(np.int64)


def search_all(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, place in ``ids`` and score of the ``top`` best for each query, ties to the smaller
    id, with every product computed: for numbers so large that distances would be rounded."""
    out = []
    for at in range(0, len(queries), 256):
        scores = exact_products(queries[at : at + 256], vectors)
        for n, row in enumerate(scores):
            may = np.flatnonzero(ids != query_ids[at + n])
            best = may[np.lexsort((ids[may], ~row[may]))[:top]]
            out += [(at + n, place, row[place]) for place in best.tolist()]
    columns = list(zip(*out)) or [(), (), ()]
    return tuple(np.array(c, np.int64) for c in columns)


def _wide_matrix(held: pa.Table, width: int) -> np.ndarray:
    """Vectors of ``v`` or ``wide`` as rows; missing components are 0."""
    out = np.zeros((held.num_rows, width), np.int64)
    for n, (v, wide) in enumerate(zip(held.column("v").to_pylist(), held.column("wide").to_pylist())):
        numbers = v if wide is None else [_wide_number(x) for x in wide]
        out[n, : len(numbers)] = numbers
    return out


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; missing components are 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    out = np.zeros((len(lists), width), np.int64)
    lengths = np.diff(lists.offsets.to_numpy())
    out[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(False)
    return out


_FOUND = "query_id bigint, query array<int>, query_wide array<double>, vec_id bigint, score bigint"
_FOUND_NAMES = ["query_id", "query", "query_wide", "vec_id", "score"]
_FOUND_KINDS = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.float64()), pa.int64(), pa.int64()]


def _answers(asked: pa.Table, ids: np.ndarray, query: np.ndarray, place: np.ndarray, score: np.ndarray) -> pa.Table:
    own = asked.take(pa.array(query, pa.int64()))
    wide = own.column("wide") if "wide" in own.column_names else pa.nulls(len(query))
    columns = [own.column("id"), own.column("v"), wide, pa.array(ids[place]), pa.array(score)]
    return pa.table([c.cast(k) for c, k in zip(columns, _FOUND_KINDS)], names=_FOUND_NAMES)


def _by_tree(asked: pa.Table, held: pa.Table, width: int, longest: float, top: int) -> pa.Table:
    """The best of a block for some queries, ``least`` of which is the least score of use."""
    if not asked.num_rows or not held.num_rows:
        return pa.table([pa.array([], k) for k in _FOUND_KINDS], names=_FOUND_NAMES)
    ids = held.column("id").to_numpy()
    by = np.argsort(ids, kind="stable")
    ids = ids[by]
    tree = Tree(_matrix(held.column("v"), width)[by], longest=longest)
    out = []
    for at in range(0, asked.num_rows, QUERIES_AT_ONCE):
        some = asked.slice(at, QUERIES_AT_ONCE)
        query_ids = some.column("id").to_numpy()
        first = np.searchsorted(ids, query_ids, "left")
        last = np.searchsorted(ids, query_ids, "right")
        # An id on several rows: look that much further, and leave them out below.
        extra = max(0, int((last - first).max()) - 1)
        own = np.where(last > first, first, -1)
        least = some.column("least").to_numpy() if "least" in some.column_names else None
        found, scores, _ = tree.search(_matrix(some.column("v"), width), own, top + extra, least)
        keep = (found >= 0) & (ids[np.maximum(found, 0)] != query_ids[:, None])
        query, place = np.nonzero(keep)
        out.append(_answers(some, ids, query, found[query, place], scores[query, place]))
    return pa.concat_tables(out)


def _numbers(lists: Column) -> Column:
    """The sum of squares of whole numbers."""
    return F.aggregate(lists, F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x.cast("long"))


def _metric(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors as floats with the component that gives all of them the same length."""
    whole = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(longest - (whole**2).sum(1), 0.0))
    return np.concatenate([whole, rest[:, None]], 1)


def _pivoted(rows: DataFrame, pivots: np.ndarray, width: int, longest: float) -> DataFrame:
    """``rows`` (``id``, ``v``) with the number of the nearest pivot and the distance to it."""
    sent = rows.sparkSession.sparkContext.broadcast(_metric(pivots, longest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2_048):
                batch = whole.slice(at, 2_048)
                own = _metric(_matrix(batch.column(1), width), longest)
                squares = np.maximum(2 * longest - 2 * (own @ points.T), 0.0)
                near = squares.argmin(1)
                away = np.sqrt(squares[np.arange(len(near)), near])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(away)],
                    ["id", "v", "pivot", "away"],
                )

    return rows.mapInArrow(released(run), "id bigint, v array<int>, pivot int, away double")


def _visits(
    bounded: DataFrame, pivots: np.ndarray, radii: np.ndarray, parts: np.ndarray, width: int, longest: float
) -> DataFrame:
    """``id``, ``v``, ``least`` and ``block``: the blocks beside its own that a query's bound
    cannot rule out. Blocks are numbered by pivot and part."""
    sent = bounded.sparkSession.sparkContext.broadcast((_metric(pivots, longest), radii, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, radius, count = sent.value
        first = np.cumsum(count) - count
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                q = _matrix(batch.column("v"), width).astype(np.float64)
                base = (q**2).sum(1) + longest
                away = np.sqrt(np.maximum(base[:, None] - 2 * (q @ points[:, :-1].T), 0.0))
                least = batch.column("least").to_numpy(False)
                reach = np.sqrt(np.maximum(base - 2 * least, 0.0)) * (1 + SLACK) + SLACK
                query, pivot = np.nonzero(away - radius[None, :] <= reach[:, None])
                query = np.repeat(query, count[pivot])
                step = np.arange(len(query)) - np.repeat(np.cumsum(count[pivot]) - count[pivot], count[pivot])
                block = np.repeat(first[pivot], count[pivot]) + step
                other = block != batch.column("block").to_numpy(False)[query]
                taken = batch.take(pa.array(query[other]))
                yield pa.RecordBatch.from_arrays(
                    [taken.column("id"), taken.column("v"), taken.column("least"), pa.array(block[other].astype(np.int32))],
                    ["id", "v", "least", "block"],
                )

    return bounded.mapInArrow(released(run), "id bigint, v array<int>, least double, block int")


def _nearest(rows: DataFrame, stats: Row, top: int, step: int, block: int, query_block: int) -> DataFrame:
    """The best candidates among ``rows`` (``id``, ``v``) for the queries among them.

    Rows go to the nearest of some pivots, and the rows of a pivot are cut into blocks. A query
    first searches the block it is in. Its k-th score bounds the distance of what it still lacks,
    and the covering radius of each pivot's rows says which blocks may hold that; only there it is
    sent, and a block is sent as often as its queries fill groups.
    """
    total, width, longest = stats["narrow"], max(stats["width"], 1), float(stats["longest"])
    if not total:
        return rows.sparkSession.createDataFrame([], _FOUND)
    picked = rows.orderBy(F.xxhash64("id", "v"), "id").limit(min(MOST_PIVOTS, tasks_for(total, block)))
    pivots = _matrix(pa.chunked_array([pa.array([r["v"] for r in picked.collect()], pa.list_(pa.int32()))]), width)
    dealt = stored(_pivoted(rows, pivots, width, longest))
    sizes = dealt.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()
    radii, parts = np.full(len(pivots), -np.inf), np.zeros(len(pivots), np.int64)
    for r in sizes:  # a row for each pivot
        radii[r["pivot"]], parts[r["pivot"]] = r["radius"], tasks_for(r["n"], block)
    first = np.cumsum(parts) - parts
    places = [(n, int(at), int(count)) for n, (at, count) in enumerate(zip(first, parts))]
    places = rows.sparkSession.createDataFrame(places, "number int, first int, parts int")
    dealt = dealt.join(F.broadcast(places), F.col("pivot") == F.col("number"))
    own = (F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("parts"))).cast("int")
    blocks = dealt.select("id", "v", own.alias("block"))
    queries = blocks.where(F.col("id") % step == 0).distinct()

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        return _by_tree(asked, held, width, longest, top)

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        """Groups of queries with the block they search."""
        counts = left.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
        groups = counts.select(F.col("block").alias("of"), F.ceil(F.col("n") / query_block).cast("int").alias("groups"))
        groups = F.broadcast(groups)  # a row for each block
        asked = left.join(groups, F.col("block") == F.col("of")).withColumn(
            "turn", F.pmod(F.xxhash64("id", "v"), F.col("groups")).cast("int")
        )
        turns = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("turn")
        # Named anew, as both sides may come from the same table.
        own = [F.col(name).alias(name) for name in ("id", "v", "block")]
        held = right.join(groups, F.col("block") == F.col("of")).select(*own, turns)
        asked = asked.drop("of", "groups")
        return asked.groupBy("block", "turn").cogroup(held.groupBy("block", "turn")).applyInArrow(search, _FOUND)

    own_best = stored(met(queries, blocks))
    one = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    last = own_best.withColumn("rank", F.row_number().over(one)).where(F.col("rank") == top)
    last = last.select(F.col("query_id").alias("q_id"), F.col("query").alias("q"), F.col("score").cast("double").alias("least"))
    bounded = queries.join(last, (queries["id"] == last["q_id"]) & (queries["v"] == last["q"]), "left")
    bounded = bounded.select("id", "v", "block", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    visits = stored(_visits(bounded, pivots, radii, parts, width, longest))
    return own_best.unionByName(met(visits, blocks))


def _among_wide(rows: DataFrame, total: int, width: int, top: int, step: int, block: int, query_block: int) -> DataFrame:
    """The best of pairs of which one vector at least is ``wide``: every product is computed."""
    queries = rows.where(F.col("id") % step == 0).distinct()
    is_wide = F.col("wide").isNotNull()

    def dealt(count: int) -> Column:
        return F.pmod(F.xxhash64("id", "v", "wide"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def search(asked: pa.Table, held: pa.Table) -> pa.Table:
        if not asked.num_rows or not held.num_rows:
            return pa.table([pa.array([], k) for k in _FOUND_KINDS], names=_FOUND_NAMES)
        ids, query_ids = held.column("id").to_numpy(), asked.column("id").to_numpy()
        matrices = [_wide_matrix(x, width) for x in (asked, held)]
        return _answers(asked, ids, *search_all(matrices[0], query_ids, matrices[1], ids, top))

    found = []
    for some, others in ((queries, rows.where(is_wide)), (queries.where(is_wide), rows.where(~is_wide))):
        blocks, groups = tasks_for(total, block), tasks_for(total // step + 1, query_block)
        left = some.select("id", "v", "wide", dealt(groups).alias("qb"), every(blocks).alias("cb"))
        right = others.select("id", "v", "wide", dealt(blocks).alias("cb"), every(groups).alias("qb"))
        found.append(left.groupBy("cb", "qb").cogroup(right.groupBy("cb", "qb")).applyInArrow(search, _FOUND))
    return found[0].unionByName(found[1])


def top_k(
    vectors: DataFrame,
    top: int = TOP,
    step: int = QUERY_STEP,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``top`` best for each query.

    Queries are the vectors whose id is divisible by ``step``; rows with a query's own id are
    no candidates for it. Vectors that are NULL, have a NULL id, or hold a NULL or non-finite
    component take no part; an empty vector, and what a shorter one lacks, counts as zeros.
    Scores are exact whenever they fit 64 bits, whatever the components. Those of vectors with a
    component beyond 2^18 are all computed, apart from the trees. Equal scores are ranked by id. A
    query that stands on several equal rows is answered once; a candidate id on several rows is
    found as often. An empty table has no rows. Other columns are not read.
    """
    rows = whole_numbers(vectors, vec_id, embedding)
    size = F.size(F.coalesce(F.col("v").cast("array<double>"), F.col("wide")))
    stats = rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("v").alias("narrow"),
        F.coalesce(F.max(size), F.lit(0)).alias("width"),
        F.coalesce(F.max(_numbers(F.col("v"))), F.lit(0)).alias("longest"),
    ).first()
    found = [_nearest(rows.where(F.col("v").isNotNull()).select("id", "v"), stats, top, step, block, query_block)]
    if stats["total"] > stats["narrow"]:
        found.append(_among_wide(rows, stats["total"], max(stats["width"], 1), top, step, block, query_block))
    both = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("query_id", "query", "query_wide").orderBy(F.desc("score"), "vec_id")
    ranked = both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOP_K_SQL = f"""
WITH parts AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.id AS query_id, c.id AS vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.id <> c.id
  WHERE q.id % {QUERY_STEP} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
