"""Near-duplicate documents by MinHash.

1. A document is the set of its distinct word shingles; documents with equal sets are one
   class, and classes are what the following steps work on.
2. Many universal hash functions give the signature of a set, their minima; bands of a few
   minima are hashed, and classes that share the hash of a band meet in a bucket.
3. The member of a bucket that meets most others, over all its bands, is its centre. Members
   of all buckets with the same centre are a family. Families are worked on in blocks of
   bounded size: signatures rule out pairs that are clearly different, the rest is confirmed
   on the full sets, and only the links of a spanning forest leave a task.
4. Alternating large-star and small-star steps turn the links into connected components.

Every pair that shares a bucket shares a family and is compared; none is dropped for the
size of a bucket. With 36 bands of 6 rows a pair at the threshold 0.85 shares no bucket with
probability 4e-8, and one at 0.8 with 2e-5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, few, released, stored

BANDS, ROWS = 36, 6
SIGNATURE_SLACK = 0.14  # a pair is ruled out if signatures agree that much less than asked
BLOCK_SHINGLES = 400_000  # shingles of the sets that a task compares at a time, about
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
MULTIPLIERS = np.random.default_rng(20).integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64)
MULTIPLIERS = (MULTIPLIERS | U64(1)).astype(np.uint32)[:, None]
SHIFTS = np.random.default_rng(21).integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64)
SHIFTS = SHIFTS.astype(np.uint32)[:, None]
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def _powers(size: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < size:
        size += size >> 4
        for n, base in enumerate((BASE, INVERSE)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _POWERS[n] = np.cumprod(steps, dtype=U64)
    return _POWERS


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def shingle_sets(raws: list[bytes], shingle: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of the distinct word shingles of each text.

    A-Z are lower-cased; words are what stands between white space. A text with fewer words
    than a shingle has its whole sequence as one shingle, one without words has none.
    """
    data = np.frombuffer(b"\n".join([*raws, b""]).lower(), np.uint8)
    space = SPACES[data]
    inside = np.concatenate(([False], ~space))
    starts = np.flatnonzero(~inside[:-1] & inside[1:])
    ends = np.flatnonzero(inside[1:] & np.concatenate((space[1:], [True]))) + 1
    power, back = _powers(len(data) + 1)
    sums = np.concatenate(([U64(0)], np.cumsum((data + U64(1)) * power[: len(data)], dtype=U64)))
    words = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64))
    sizes = np.array([len(x) + 1 for x in raws], np.int64)
    bounds = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    full = np.zeros(max(len(words) - shingle + 1, 0), U64)
    for j in range(shingle):
        full = full * BASE + words[j : j + len(full)]
    full = mixed(full)
    out = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= shingle:
            out.append(np.unique(full[first : last - shingle + 1]))
        else:
            short = np.full(int(last > first), last - first, U64)
            for word in words[first:last]:
                short = mixed(short * BASE + word)
            out.append(short)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of the universal hash functions a * x + b modulo 2^32."""
    low = (shingles >> U64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for first in range(0, len(low), 2048):
        part = low[first : first + 2048]
        out = np.minimum(out, (part[None, :] * MULTIPLIERS + SHIFTS).min(1))
    return out


def bands_of(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(BANDS, ROWS).astype(U64)
    key = np.arange(1, BANDS + 1, dtype=U64)
    for row in rows.T:
        key = mixed(key * BASE + row)
    return key.astype(np.int64)


def node_of(shingles: np.ndarray) -> tuple[int | None, int | None]:
    """The class of a set, and a check of it: 64 bits each of a digest of all its hashes; none for
    the empty set. Sets of one class that differ in the check are told apart by ``classified``."""
    if not len(shingles):
        return None, None
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return tuple(int.from_bytes(digest[at : at + 8], "big", signed=True) for at in (0, 8))


def _raws(batch: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in batch.column("__text").cast(pa.binary()).to_pylist()]


def described(
    docs: DataFrame, shingle: int, text: str = "text", keep: dict[str, Column] | None = None
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node``, ``check`` and ``bands`` of every row, and the columns
    of ``keep``."""
    names = list(keep or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text"):
            counts, nodes, checks, bands = [], [], [], []
            for found in shingle_sets(_raws(batch), shingle):
                node, check = node_of(found)
                counts.append(len(found))
                nodes.append(node)
                checks.append(check)
                bands.append(bands_of(signature(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *batch.columns[1:-1],
                    pa.array(counts, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(checks, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", *names, "n_shingles", "node", "check", "bands"],
            )

    kept = [value.alias(name) for name, value in (keep or {}).items()]
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *kept, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(
        released(run), f"{fields}, n_shingles bigint, node bigint, check bigint, bands array<bigint>"
    )


def classified(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` with a ``node`` for each different set, and the classes of those that have any:
    ``node``, ``check``, ``least`` id, ``n_shingles`` and ``bands``.

    Where sets of one node differ in the check, the node is made of both: 128 bits tell sets apart.
    """

    def classes_of(table: DataFrame) -> DataFrame:
        return stored(
            table.where(F.col("node").isNotNull())
            .groupBy("node")
            .agg(
                F.min("doc_id").alias("least"),
                F.max("n_shingles").alias("n_shingles"),
                F.min("check").alias("check"),
                F.max("check").alias("other"),
                F.first("bands").alias("bands"),
            )
        )

    classes = classes_of(rows)
    mixed_up = classes.where(F.col("check") != F.col("other")).select(F.col("node").alias("__node"))
    if mixed_up.limit(1).count():
        marked = rows.join(few(mixed_up), F.col("node") == F.col("__node"), "left")
        both = F.xxhash64("node", "check")
        rows = stored(
            marked.withColumn("node", F.when(F.col("__node").isNotNull(), both).otherwise(F.col("node"))).drop("__node")
        )
        classes = classes_of(rows)
    return rows, classes.drop("other")


def families(classes: DataFrame) -> DataFrame:
    """Pairs (``centre``, ``node``) of all members of buckets with their bucket's centre."""
    keyed = classes.select(F.explode("bands").alias("key"), "node")
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(keyed.join(sizes, "key"))
    met = members.groupBy("node").agg(F.sum("size").alias("met"))
    ranked = members.select("key", "node").join(met, "node")
    centres = (
        ranked.groupBy("key").agg(F.max(F.struct("met", "node")).alias("top")).select("key", F.col("top.node").alias("centre"))
    )
    return stored(
        members.select("key", "node").join(centres, "key").select("centre", "node").where("centre <> node").distinct()
    )


def sets_of(docs: DataFrame, wanted: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """``node`` and ``shingles`` (packed hashes) of the classes in ``wanted`` (``node``, ``check``,
    ``least``): the text of one document of each is read again."""
    source = (
        docs.select(F.col("doc_id").cast("long").alias("least"), F.col(text).alias("__text"))
        .join(few(wanted), "least")
        .select("node", "check", "__text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text"):
            sets = shingle_sets(_raws(batch), shingle)
            # An id may stand on several rows; only the text that makes the class counts.
            keep = [node_of(s)[1] == c for s, c in zip(sets, batch.column("check").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").filter(pa.array(keep)),
                    pa.array([s.tobytes() for s, k in zip(sets, keep) if k], pa.binary()),
                ],
                ["node", "shingles"],
            )

    return stored(
        source.mapInArrow(released(run), "node bigint, shingles binary").dropDuplicates(["node"])
    )


def _forest(nodes: list[int], sets: list[np.ndarray], centre: int, percent: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of a block: ``percent`` of the union in common."""
    size = len(nodes)
    order = sorted(range(size), key=lambda i: nodes[i] != centre)
    parent = list(range(size))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    lengths = np.array([len(s) for s in sets], np.int64)
    signs = np.array([signature(s) for s in sets]).astype(np.uint8) if size > 2 else None
    least = percent / 100 - SIGNATURE_SLACK
    links = []
    for n, i in enumerate(order[:-1]):
        others = np.array(order[n + 1 :])
        small, large = np.minimum(lengths[others], lengths[i]), np.maximum(lengths[others], lengths[i])
        others = others[100 * small >= percent * large]
        if signs is not None and len(others):
            others = others[(signs[others] == signs[i]).mean(1) >= least]
        own = root(i)
        for j in others.tolist():
            other = root(j)
            if other == own:
                continue
            both = np.concatenate((sets[i], sets[j]))
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= percent * (len(both) - common):
                parent[other] = own
                links.append((nodes[i], nodes[j]))
    return links


def links_of(pairs: DataFrame, sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Links (``src``, ``dst``) between classes, enough to connect what is linked.

    A family is cut into blocks by a hash, as many as its shingles need; each pair of blocks
    is compared by one task, together with the centre.
    """
    weighed = pairs.join(sizes, "node")
    parts = weighed.groupBy("centre").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("parts")
    )
    blocks = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")))
    member = (
        pairs.join(parts, "centre")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .select("centre", "node", F.explode(blocks).alias("at"))
    )
    # Pairs of blocks by two steps, so that no row holds all of a family.
    first = parts.select("centre", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
    every = first.select("centre", "i", F.explode(F.sequence(F.col("i"), F.col("parts") - 1)).alias("j"))
    centre = every.select("centre", F.col("centre").alias("node"), F.struct("i", "j").alias("at"))
    rows = member.unionByName(centre).join(sets, "node")
    rows = rows.select("centre", F.col("at.i").alias("i"), F.col("at.j").alias("j"), "node", "shingles")
    dealt = rows.repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sets = None, [], []
        found: list[tuple[int, int]] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*found)) or [(), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["src", "dst"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in range(5)]
            for centre, i, j, node, packed in zip(*columns):
                if (centre, i, j) != key:
                    if key is not None:
                        found += _forest(nodes, sets, key[0], percent)
                    key, nodes, sets = (centre, i, j), [], []
                nodes.append(node)
                sets.append(np.frombuffer(packed, U64))
            if len(found) >= 10_000:
                yield batch_of()
                found = []
        if key is not None:
            found += _forest(nodes, sets, key[0], percent)
        yield batch_of()

    return stored(dealt.mapInArrow(released(run), "src bigint, dst bigint").distinct())


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node that it is connected with, of all linked nodes.

    Alternates large-star (link every larger neighbour to the least neighbour) and small-star
    (link every smaller one to it) until the links no longer change; then each component is a
    star around its least node. Neighbours are reduced to minima and joined back, so a node
    with very many links is never gathered in one place.
    """
    now = links.where("src <> dst").select(
        F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo")
    )
    now = stored(now.distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m"))
        large = (
            both.where("lo > hi").join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        )
        large = stored(large)
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(smallest, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("m").alias("lo"))
        now = stored(small.where("hi <> lo").distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("label")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("label")).distinct()
    )


def components(docs: DataFrame, shingle: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Two documents are linked when ``percent`` of the union of their shingle sets is in both;
    ``component_id`` is the least ``doc_id`` that can be reached over links. A NULL or empty
    text, or one of white space, has no shingles and is linked with nothing. Rows that repeat
    an id count as documents of their own; a NULL id is never the least of a component, such a
    row is not kept, and texts that only such rows have are linked with nothing. Other columns
    are not read.
    """
    out = _labelled(docs, shingle, percent, text).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _labelled(
    docs: DataFrame, shingle: int, percent: int, text: str, keep: dict[str, Column] | None = None
) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``n_shingles``, ``label`` (one for each component; NULL
    without shingles) and ``component_id`` of every row."""
    kept = list(keep or {})
    rows, classes = classified(stored(described(docs, shingle, text, keep)))
    filled = rows.where(F.col("node").isNotNull())
    pairs = families(classes)
    wanted = pairs.select("node").unionByName(pairs.select(F.col("centre").alias("node"))).distinct()
    wanted = stored(classes.select("node", "check", "least", "n_shingles").join(wanted, "node", "left_semi"))
    sets = sets_of(docs, wanted.select("node", "check", "least"), shingle, text)
    labels = connected(links_of(pairs, sets, wanted.select("node", "n_shingles"), percent))
    named = classes.select("node", "least").join(labels, "node")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = named.select("node", "label").join(least, "label").select("node", "label", "component_id")
    own = classes.select("node", "least").join(of_node, "node", "left")
    own = own.select(
        "node", F.coalesce("label", "node").alias("label"), F.coalesce("component_id", "least").alias("component_id")
    )
    own = stored(own)  # a table of its own: adaptive execution can split the class of a third of the rows
    full = filled.select("doc_id", *kept, "n_shingles", "node").join(own, "node")
    empty = rows.where(F.col("node").isNull())
    names = ["doc_id", *kept, "n_shingles", "label", "component_id"]
    return full.select(*names).unionByName(
        empty.withColumns({"label": F.lit(None).cast("long"), "component_id": F.col("doc_id")}).select(*names)
    )


def deduplicated(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near copies, one with the least id.

    Groups are of rows, whatever their ids: rows that share an id and are no near copies both
    stay. Rows with a NULL id, and those without words, stay too. Of rows of a group that share
    its least id one stays. An empty table stays empty.
    """
    # A row is found again by its id and 128 bits of a hash of its text.
    marks = {"__a": F.xxhash64("text"), "__b": F.xxhash64(F.lit(1), "text")}
    found = stored(_labelled(docs, shingle, percent, "text", marks))
    grouped = found.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    keys = ["doc_id", *marks]
    counted = grouped.groupBy("label", *keys).agg(F.count(F.lit(1)).alias("rows"))
    first = counted.groupBy("label").agg(F.min(F.struct(*keys)).alias("first"))
    first = first.select("label", "first.*", F.lit(True).alias("stays"))
    # By all columns, so that a group of a third of the rows is met by many tasks.
    judged = counted.join(first, ["label", *keys], "left")
    judged = stored(
        judged.groupBy(*keys).agg(
            F.max(F.coalesce("stays", F.lit(False))).alias("stays"), F.sum("rows").alias("rows")
        )
    )
    marked = docs.withColumns(marks)
    kept = marked.join(few(judged.where(~F.col("stays")).select(*keys)), keys, "left_anti")
    repeated = judged.where(F.col("stays") & (F.col("rows") > 1)).select(*keys)
    if not repeated.limit(1).count():
        return kept.select(*docs.columns)
    again = kept.join(repeated, keys, "left_semi").dropDuplicates(keys)
    once = kept.join(repeated, keys, "left_anti")
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))


def query(docs: DataFrame) -> DataFrame:
    """``components`` with the shingles and the bound of the contract; the same holds for NULLs,
    empty texts, repeated rows, empty tables and further columns."""
    return components(docs, shingle=3, percent=85)
