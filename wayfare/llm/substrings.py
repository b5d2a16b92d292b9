"""Word sequences that stand more than once in a corpus.

A window is ``window`` consecutive words. Blocks of ``(window + 1) // 2`` words that do not
overlap are the anchors: each window holds a whole block of its text, so a window that stands
twice holds a place where a block of one text is found in the other.

1. ``_sent``: every place where a block could stand (the rolling windows of block length) is
   hashed. Texts are packed into parcels, and a parcel sends each of its distinct hashes to the
   shard of the hash once, marked if one of the parcel's own blocks is there.
2. ``_answered``: a shard finds the hashes that several places share and names to each of them
   the least one, its origin, and whether a block is among them (a hit).
3. ``_extended``: in a parcel, hits are extended over neighbouring shared places to stretches as
   long as a window at least. Where the origins at both ends of a window lie on one diagonal, the
   window stands at that origin; the stretch is confirmed, and its origin is told of it. Windows
   whose ends have origins on different diagonals are sent to shards once more, as pairs of
   origins.
4. ``_confirmed``: a shard finds the pairs that several windows share.
5. ``_covered``: a parcel joins all confirmed stretches to maximal spans of words.

Nothing is sent twice by a parcel, so a passage of a third of all texts costs a shard one entry
per parcel, and no pairs of places are ever listed. All messages are narrow and packed.

Hashes have 48 bits above which the shard is spread; a false window needs an equal hash at one
given place (2^-48), and texts are told apart by their MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, release, released, stored
from wayfare.llm.near_dup import BASE, SPACES, U64, _powers, mixed

WINDOW = 35
# Entries of a shard and words of a parcel grow with the root of the corpus, so that a parcel has
# some entries for each shard at any size.
LEAST_SHARD, LEAST_PARCEL, LEAST_SHARDS = 2_000_000, 1_000_000, 64
BROADCAST_SPANS = 2_000_000  # numbers of a span table that is sent to all tasks
PLACES, LOCAL, TEXTS, TOLD, DONE = range(5)  # kinds of messages
MESSAGE = "to bigint, kind int, parcel bigint, a binary, b binary, c binary"
NAMES = ["to", "kind", "parcel", "a", "b", "c"]
Row = tuple[int, int, int, bytes, bytes, bytes]


def _pack(values: np.ndarray, width: int) -> bytes:
    """``width`` bytes of each number, the first bytes of all, then the second: bytes that hardly
    change are next to each other, where the shuffle's compression removes them."""
    rows = np.ascontiguousarray(values, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return rows[:, :width].T.tobytes()


def _unpack(packed: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(width, -1)
    rows = np.zeros((planes.shape[1], 8), np.uint8)
    rows[:, :width] = planes.T
    return rows.view("<u8").ravel().astype(np.int64)


HASH, PLACE, NUMBER = 6, 5, 8  # bytes of a hash, of a place with a flag, and of other numbers


def _batch(rows: list[Row]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 6
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], NAMES)


def _grouped(run: Callable[[list[Row]], list[Row]]) -> Callable[[pa.Table], pa.Table]:
    """``run`` on the messages to one address, by parcel, for ``applyInArrow``."""

    def wrapped(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*[table.column(n).to_pylist() for n in NAMES]), key=lambda r: (r[2], r[1]))
        out = pa.Table.from_batches([_batch(run(rows))])
        release()
        return out

    return wrapped


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and where the words of each text begin and end."""
    data = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
    inside = np.concatenate(([False], ~SPACES[data], [False]))
    starts = np.flatnonzero(~inside[:-1] & inside[1:])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    power, back = _powers(len(data) + 1)
    sums = np.concatenate(([U64(0)], np.cumsum((data + U64(1)) * power[: len(data)], dtype=U64)))
    words = mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(U64))
    sizes = np.array([len(x) + 1 for x in raws], np.int64)
    return words, np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))


def _rolling(words: np.ndarray, block: int) -> np.ndarray:
    """48 bits of a hash of every ``block`` words in a row."""
    full = np.zeros(max(len(words) - block + 1, 0), U64)
    for j in range(block):
        full = full * BASE + words[j : j + len(full)]
    return mixed(full) >> U64(16)


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _dealt(high: np.ndarray, shards: int, columns: list[tuple[np.ndarray, int]], parcel: int) -> list[Row]:
    """One message for each shard; ``high`` are 32 sorted bits that choose the shard."""
    shard = (high * U64(shards) >> U64(32)).astype(np.int64)
    starts = _runs(shard)
    rows = []
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(shard)]):
        packed = [_pack(values[s:e], width) for values, width in columns]
        rows.append((int(shard[s]), PLACES, parcel, *packed, *[b""] * (3 - len(packed))))
    return rows


def _home(parcel: int, shards: int) -> int:
    """The shard through which messages to a parcel go."""
    return (parcel * 0x9E3779B97F4A7C15 % (1 << 64)) * shards >> 64


class _Parcel:
    """Texts whose places are numbered together, with one number left out after each text."""

    def __init__(self, number: int, window: int, shards: int) -> None:
        self.number, self.window, self.shards = number, window, shards
        self.block = (window + 1) // 2
        self.rank: dict[bytes, int] = {}
        self.starts: list[int] = []
        self.sizes: list[int] = []
        self.copied: list[bool] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, raws: list[bytes]) -> None:
        new: list[bytes] = []
        digests: list[bytes] = []
        met: dict[bytes, int] = {}
        again = []
        for raw in raws:
            digest = hashlib.md5(raw).digest()
            if digest in self.rank or digest in met:
                again.append(digest)
            else:
                met[digest] = len(new)
                new.append(raw)
                digests.append(digest)
        if new:
            self._add(new, digests)
        for digest in again:  # a text that is there twice is repeated as a whole
            if digest in self.rank:
                self.copied[self.rank[digest]] = True

    def _add(self, raws: list[bytes], digests: list[bytes]) -> None:
        words, bounds = word_hashes(raws)
        counts = np.diff(bounds)
        fits = counts >= self.window
        starts = self.size + np.concatenate(([0], np.cumsum((counts + 1) * fits)))
        for n in np.flatnonzero(fits).tolist():
            self.rank[digests[n]] = len(self.starts)
            self.starts.append(int(starts[n]))
            self.sizes.append(int(counts[n]))
            self.copied.append(False)
        self.size = int(starts[-1])
        hashes = _rolling(words, self.block)
        text = np.repeat(np.arange(len(raws)), counts)[: len(hashes)]
        own = np.arange(len(hashes)) - bounds[text]
        keep = fits[text] & (own + self.block <= counts[text])
        own, text = own[keep], text[keep]
        self.parts.append((hashes[keep], starts[text] + own, own % self.block == 0))

    def messages(self) -> list[Row]:
        if not self.starts:
            return []
        hashes, places, aligned = (np.concatenate(x) for x in zip(*self.parts))
        order = np.argsort(hashes, kind="stable")
        hashes, places = hashes[order], places[order]
        first = _runs(hashes)
        counts = np.diff(np.append(first, len(hashes)))
        anchor = np.logical_or.reduceat(aligned[order], first)
        distinct = hashes[first]
        marked = places[first] * 2 + anchor
        rows = _dealt(distinct >> U64(16), self.shards, [(distinct, HASH), (marked, PLACE)], self.number)
        home = _home(self.number, self.shards)
        later = np.ones(len(hashes), bool)
        later[first] = False
        if later.any():
            of = np.repeat(marked, counts)[later]
            rows.append((home, LOCAL, self.number, _pack(places[later], PLACE), _pack(of, PLACE), b""))
        sizes = np.array(self.sizes) * 2 + np.array(self.copied)
        rows.append(
            (home, TEXTS, self.number, b"".join(self.rank), _pack(np.array(self.starts), NUMBER), _pack(sizes, NUMBER))
        )
        return rows


def _sender(window: int, shards: int, parcel_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        parcel = _Parcel(number, window, shards)
        for batch in chunks(batches, "__text"):
            parcel.add([x or b"" for x in batch.column("__text").cast(pa.binary()).to_pylist()])
            if parcel.size >= parcel_words:
                yield _batch(parcel.messages())
                number += 1
                parcel = _Parcel(number, window, shards)
        yield _batch(parcel.messages())

    return run


def _answered(rows: list[Row]) -> list[Row]:
    """A shard's answers: the places that share a hash with others, with their origin."""
    out = [(r[2], *r[1:]) for r in rows if r[1] != PLACES]
    asked = [r for r in rows if r[1] == PLACES]
    if not asked:
        return out
    parts = [(_unpack(r[3], HASH), _unpack(r[4], PLACE)) for r in asked]
    of = np.repeat(np.arange(len(asked)), [len(p[0]) for p in parts])
    hashes, marked = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(hashes, kind="stable")  # parcels stay in order: the origin comes first
    hashes, marked, of = hashes[order], marked[order], of[order]
    first = _runs(hashes)
    counts = np.diff(np.append(first, len(hashes)))
    anchor = np.repeat(np.bitwise_or.reduceat(marked & 1, first), counts)
    origin = np.repeat(first, counts)
    shared = np.flatnonzero(np.repeat(counts > 1, counts))
    shared = shared[np.argsort(of[shared], kind="stable")]
    parcels = np.array([r[2] for r in asked])
    starts = _runs(of[shared]).tolist()
    for s, e in zip(starts, [*starts[1:], len(shared)]):
        members = shared[s:e]
        if not len(members):
            continue
        parcel = int(parcels[of[members[0]]])
        from_ = origin[members]
        out.append((
            parcel, PLACES, parcel,
            _pack((marked[members] >> 1) * 2 + anchor[members], PLACE),
            _pack(parcels[of[from_]], NUMBER),
            _pack(marked[from_] >> 1, PLACE),
        ))
    return out


def _stretches(places: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs in which places, and each of ``others``, rise by one."""
    steps = np.arange(len(places))
    first = _runs(places - steps, *[x - steps for x in others])
    return first, np.diff(np.append(first, len(places)))


def _extender(window: int, shards: int):
    shift = window - (window + 1) // 2

    def run(rows: list[Row]) -> list[Row]:
        texts = next(r for r in rows if r[1] == TEXTS)
        parcel, home = texts[2], _home(texts[2], shards)
        starts, sizes = _unpack(texts[4], NUMBER), _unpack(texts[5], NUMBER) >> 1
        total = int(starts[-1] + sizes[-1]) + 1
        from_parcel, from_place = np.full(total, -1), np.zeros(total, np.int64)
        hit = np.zeros(total, bool)
        local = [(_unpack(r[3], PLACE), _unpack(r[4], PLACE)) for r in rows if r[1] == LOCAL]
        for places, marked in local:
            first = marked >> 1
            from_parcel[first], from_place[first] = parcel, first
            hit[first] |= (marked & 1).astype(bool)
        for r in rows:
            if r[1] == PLACES:
                marked = _unpack(r[3], PLACE)
                from_parcel[marked >> 1], from_place[marked >> 1] = _unpack(r[4], NUMBER), _unpack(r[5], PLACE)
                hit[marked >> 1] |= (marked & 1).astype(bool)
        for places, marked in local:
            first = marked >> 1
            for values in (from_parcel, from_place, hit):
                values[places] = values[first]
        # A window is a run of shared places with a hit among them.
        shared = np.concatenate(([0], np.cumsum(from_parcel >= 0)))
        hits = np.concatenate(([0], np.cumsum(hit)))
        ends = np.arange(shift + 1, total + 1)
        begins = ends - shift - 1
        whole = (shared[ends] - shared[begins] == shift + 1) & (hits[ends] > hits[begins])
        at = begins[whole]
        to, place = from_parcel[at], from_place[at]
        diagonal = (from_parcel[at + shift] == to) & (from_place[at + shift] == place + shift)
        done = [at[diagonal & ~((to == parcel) & (place == at))]]
        out = [(home, *texts[1:])]
        told_to, told = to[diagonal], place[diagonal]
        other = (told_to != parcel) | (told != at[diagonal])
        told_to, told = told_to[other], told[other]
        here = told_to == parcel
        done.append(told[here])
        told_to, told, own = told_to[~here], told[~here], at[diagonal][other][~here]
        if len(told):
            cuts = np.union1d(_stretches(own, told)[0], _runs(told_to))
            length = np.diff(np.append(cuts, len(told)))
            found = np.unique(np.stack((told_to[cuts], told[cuts], length), 1), axis=0)
            heads = _runs(found[:, 0]).tolist()
            for s, e in zip(heads, [*heads[1:], len(found)]):
                target = int(found[s, 0])
                packed = _pack(found[s:e, 1], PLACE), _pack(found[s:e, 2], PLACE)
                out.append((_home(target, shards), TOLD, target, *packed, b""))
        rest = at[~diagonal]
        if len(rest):
            ends_ = [(from_parcel[x].astype(U64), from_place[x].astype(U64)) for x in (rest, rest + shift)]
            one, two = (mixed(mixed(p) * BASE + x) for p, x in ends_)
            order = np.lexsort((two, one))
            one, two, rest = one[order], two[order], rest[order]
            first = _runs(one, two)
            counts = np.diff(np.append(first, len(rest)))
            done.append(rest[np.repeat(counts > 1, counts)])
            columns = [(one[first], NUMBER), (two[first], NUMBER), (rest[first], PLACE)]
            out += _dealt(one[first] >> U64(32), shards, columns, parcel)
        sure = np.unique(np.concatenate(done))
        if len(sure):
            first, length = _stretches(sure)
            out.append((home, DONE, parcel, _pack(sure[first], PLACE), _pack(length, PLACE), b""))
        return out

    return run


def _confirmed(rows: list[Row]) -> list[Row]:
    """A shard's answers: windows that share the origins at both ends with others."""
    out = [(r[2], *r[1:]) for r in rows if r[1] != PLACES]
    asked = [r for r in rows if r[1] == PLACES]
    if not asked:
        return out
    parts = [(_unpack(r[3], NUMBER), _unpack(r[4], NUMBER), _unpack(r[5], PLACE)) for r in asked]
    of = np.repeat(np.arange(len(asked)), [len(p[0]) for p in parts])
    one, two, places = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((two, one))
    first = _runs(one[order], two[order])
    counts = np.diff(np.append(first, len(order)))
    shared = np.sort(order[np.repeat(counts > 1, counts)])
    for n, r in enumerate(asked):
        found = places[shared[of[shared] == n]] if len(shared) else shared
        if len(found):
            out.append((r[2], DONE, r[2], _pack(found, PLACE), _pack(np.ones(len(found), np.int64), PLACE), b""))
    return out


def _coverer(window: int):
    def run(table: pa.Table) -> pa.Table:
        rows = list(zip(*[table.column(n).to_pylist() for n in NAMES]))
        texts = next(r for r in rows if r[1] == TEXTS)
        starts, sizes = _unpack(texts[4], NUMBER), _unpack(texts[5], NUMBER)
        copied, sizes = (sizes & 1).astype(bool), sizes >> 1
        change = np.zeros(int(starts[-1] + sizes[-1]) + 2, np.int64)
        for r in rows:
            if r[1] in (TOLD, DONE):
                places = _unpack(r[3], PLACE)
                np.add.at(change, places, 1)
                np.add.at(change, places + _unpack(r[4], PLACE) - 1 + window, -1)
        change[starts[copied]] += 1
        change[(starts + sizes)[copied]] -= 1
        covered = np.concatenate(([False], np.cumsum(change) > 0, [False]))
        begins = np.flatnonzero(~covered[:-1] & covered[1:])
        ends = np.flatnonzero(covered[:-1] & ~covered[1:])
        text = np.searchsorted(starts, begins, "right") - 1
        heads = _runs(text)
        digests = [texts[3][16 * n : 16 * n + 16] for n in text[heads].tolist()]
        at = pa.array(np.append(heads, len(text)), pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(x - starts[text])) for x in (begins, ends)]
        return pa.table([pa.array(digests, pa.binary()), *lists], ["digest", "starts", "ends"])

    return run


def sizes_for(words: int) -> tuple[int, int]:
    """Number of shards, and words of a parcel, for a corpus of about so many words."""
    entries = max(LEAST_SHARD, 4 * isqrt(words))
    return max(LEAST_SHARDS, words // entries), max(LEAST_PARCEL, 16 * words // entries)


def spans(docs: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``digest`` (MD5 of a text), ``starts`` and ``ends``: the maximal runs of words that are
    covered by windows which also begin anywhere else; a row for each text that has any.

    Places in a text are counted in words from 0, ends are exclusive. ``docs`` should come from
    files, as a lost task reads its rows again in the same order.
    """
    source = docs.select(F.col(text).alias("__text"))
    total = source.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    shards, parcel_words = sizes_for(total // 6)
    sent = source.mapInArrow(released(_sender(window, shards, parcel_words)), MESSAGE)
    for step in (_answered, _extender(window, shards), _confirmed):
        sent = sent.groupBy("to").applyInArrow(_grouped(step), MESSAGE)
    found = sent.groupBy("to").applyInArrow(
        _coverer(window), "digest binary, starts array<bigint>, ends array<bigint>"
    )
    # A text of several parcels is covered in all of them alike.
    return stored(found).dropDuplicates(["digest"])


def without_repeats(
    docs: DataFrame, window: int = WINDOW, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep``, ``n_words``, ``n_removed`` and ``kept_text``: the words that no repeated
    window covers, joined by single spaces.

    Words are what stands between white space (U+0020, U+0009 to U+000D), unchanged. A window of
    ``window`` words is repeated if its sequence also begins anywhere else, in the same text or
    another; all its occurrences go, and windows are judged on the input. One row per input row;
    rows that repeat an id or a text count as texts of their own, with a NULL id too. A NULL or
    empty text has no words, a shorter one no window. An empty table gives none. Other columns
    are not read, whatever their names.
    """
    found = stored(spans(docs, window, text))
    size = found.agg(F.sum(F.size("starts") + 8)).first()[0] or 0
    found = F.broadcast(found) if size <= BROADCAST_SPANS else found
    source = docs.select(*keep, F.col(text).alias("__text"))
    source = source.withColumn("__digest", F.unhex(F.md5("__text")))
    found = found.select(F.col("digest").alias("__of"), F.col("starts").alias("__starts"), F.col("ends").alias("__ends"))
    joined = source.join(found, source["__digest"] == found["__of"], "left")
    joined = joined.select(*keep, "__starts", "__ends", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text"):
            raws = batch.column("__text").cast(pa.binary()).to_pylist()
            cuts = zip(batch.column("__starts").to_pylist(), batch.column("__ends").to_pylist())
            counts, removed, kept = [], [], []
            for raw, (starts, ends) in zip(raws, cuts):
                words = (raw or b"").split()  # bytes: only the six ASCII separators
                counts.append(len(words))
                gone = 0
                for s, e in reversed(list(zip(starts or (), ends or ()))):
                    del words[s:e]
                    gone += e - s
                removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                [*keep, "n_words", "n_removed", "kept_text"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema[: len(keep)])
    return joined.mapInArrow(released(run), f"{fields}, n_words bigint, n_removed bigint, kept_text string")


def digests(docs: DataFrame) -> DataFrame:
    """Per document the number of its words, of those removed, and a digest of the rest."""
    done = without_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


DIGESTS_SQL = r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
begun AS (
    SELECT r, p, array_to_string(w[p : p + 34], ' ') AS words
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM doc)),
again AS (
    SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY words) AS n FROM begun) WHERE n > 1),
word AS (
    SELECT d.r, d.p, d.word,
           coalesce(max(CASE WHEN a.p IS NULL THEN 0 ELSE 1 END)
               OVER (PARTITION BY d.r ORDER BY d.p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
    FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM doc) AS d
    LEFT JOIN again AS a ON a.r = d.r AND a.p = d.p),
rest AS (
    SELECT r, CAST(sum(gone) AS BIGINT) AS n_removed,
           string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS kept
    FROM word GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM doc AS d LEFT JOIN rest ON rest.r = d.r
"""
