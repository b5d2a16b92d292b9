"""Byte-level BPE with a vectorised pre-tokeniser.

Where a text is cut before merging is found without a regular expression. Each character
has a class, each class is a function from the state before the character to the state
after it, and such functions compose associatively. The finite set of all compositions is
enumerated once, so a block-wise prefix scan of table look-ups gives the state before every
character of many texts at a time; state, class and the next character decide the cuts.

The slices between cuts are merged once per distinct slice and kept in a bounded cache.
Offsets of the tokens are kept, and decoding places the bytes of each token there.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, cut, released, texts

# Character classes. The public split pattern knows letters, numbers, white
# space, the rest, and the contractions 's 't 'm 'd 're 've 'll.
SPACE, WHITE, NUMBER, QUOTE, OTHER, LETTER, ONE, TWO, END = range(9)
CLASSES = 9
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
WHITE_SPACE += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTED_ONE, CONTRACTED_TWO = "stmd", {"r": "e", "v": "e", "l": "l"}

# States: what the character before belongs to.
STATES = START, IN_LETTERS, IN_NUMBERS, IN_OTHER, LONE_QUOTE, AFTER_SPACE, AFTER_WHITE, HALF, WHOLE = range(9)

CACHED_SLICES = 200_000  # distinct slices that a worker remembers before it starts afresh
SCAN_WIDTH = 256
TEXT_AT_ONCE = 1 << 19  # bytes that are encoded together, or one longer text
TOKENS_AT_ONCE = 1 << 18  # tokens that are decoded together, or those of one longer text
LONG_SLICE = 64  # bytes; longer slices are merged one by one with a heap
NO_MERGE = np.iinfo(np.int32).max


def _step(state: int, kind: int) -> int:
    if kind == END:
        return START
    if kind == SPACE:
        return AFTER_SPACE
    if kind == WHITE:
        return AFTER_WHITE
    if kind == NUMBER:
        return IN_NUMBERS
    if kind == OTHER:
        return IN_OTHER
    if kind == QUOTE:
        return IN_OTHER if state in (IN_OTHER, LONE_QUOTE, AFTER_SPACE) else LONE_QUOTE
    if state == HALF or (state == LONE_QUOTE and kind == ONE):
        return WHOLE
    return HALF if state == LONE_QUOTE and kind == TWO else IN_LETTERS


def _cut(state: int, kind: int, before_word: bool) -> bool:
    """Whether a slice begins at a character. ``before_word``: a non-space comes next."""
    if kind == END:
        return False
    if kind in (SPACE, WHITE):
        # A run of spaces leaves its last one to what follows.
        return before_word or state not in (AFTER_SPACE, AFTER_WHITE)
    if kind == NUMBER:
        return state not in (IN_NUMBERS, AFTER_SPACE)
    if kind in (QUOTE, OTHER):
        return state not in (IN_OTHER, LONE_QUOTE, AFTER_SPACE)
    if state == LONE_QUOTE:
        return kind == LETTER
    return state not in (IN_LETTERS, AFTER_SPACE, HALF)


class Splitter:
    """Where slices begin, for arrays of code points."""

    def __init__(self) -> None:
        kinds = np.full(0x110001, OTHER, np.uint8)
        for point in range(0x110000):
            major = unicodedata.category(chr(point))[0]
            if major in "LN":
                kinds[point] = LETTER if major == "L" else NUMBER
        kinds[WHITE_SPACE] = WHITE
        kinds[0x20], kinds[ord("'")], kinds[0x110000] = SPACE, QUOTE, END
        kinds[[ord(x) for x in CONTRACTED_ONE]] = ONE
        self.kinds = kinds
        # All functions that compositions of the class functions can give.
        found = {tuple(_step(s, k) for s in STATES): k for k in range(CLASSES)}
        functions = [tuple(_step(s, k) for s in STATES) for k in range(CLASSES)]
        self.of_kind = np.array([found[f] for f in functions], np.uint16)
        todo = list(functions)
        while todo:
            first = todo.pop()
            for then in functions[:CLASSES]:
                both = tuple(then[s] for s in first)
                if both not in found:
                    found[both] = len(functions)
                    functions.append(both)
                    todo.append(both)
        self.result = np.array(functions, np.uint8)
        self.size = len(functions)
        index = {f: i for i, f in reversed(list(enumerate(functions)))}
        self.compose = np.array(
            [[index[tuple(b[s] for s in a)] for b in functions] for a in functions], np.uint16
        ).ravel()
        self.cuts = np.array(
            [[[_cut(s, k, w) for w in (False, True)] for k in range(CLASSES)] for s in STATES]
        ).ravel()

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """Inclusive scan: the composition of all functions up to each place."""
        if len(functions) <= SCAN_WIDTH:
            out = functions.copy()
            for i in range(1, len(out)):
                out[i] = self.compose[int(out[i - 1]) * self.size + out[i]]
            return out
        rows = -(-len(functions) // SCAN_WIDTH)
        # Trailing places are only filled up; what stands there is not returned.
        padded = np.resize(functions, rows * SCAN_WIDTH)
        lanes = padded.reshape(rows, SCAN_WIDTH).T.astype(np.int32)
        for i in range(1, SCAN_WIDTH):
            lanes[i] = self.compose[lanes[i - 1] * self.size + lanes[i]]
        before = self.prefixes(lanes[-1].astype(np.uint16)).astype(np.int32)
        lanes[:, 1:] = self.compose[before[None, :-1] * self.size + lanes[:, 1:]]
        return lanes.T.reshape(-1)[: len(functions)].astype(np.uint16)

    def starts(self, points: np.ndarray) -> np.ndarray:
        """A flag for each code point (0x110000 ends a text): a slice begins here."""
        kinds = self.kinds[points]
        following = np.append(points[1:], 0x110000)
        for letter, second in CONTRACTED_TWO.items():
            kinds[(points == ord(letter)) & (following == ord(second))] = TWO
        states = self.result[self.prefixes(self.of_kind[kinds]), START]
        states = np.concatenate(([np.uint8(START)], states[:-1]))
        ahead = self.kinds[following]
        before_word = (ahead != SPACE) & (ahead != WHITE) & (ahead != END)
        return self.cuts[(states.astype(np.int32) * CLASSES + kinds) * 2 + before_word]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Decoder:
    """The bytes of the tokens of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        tokens = [b""] * size
        for token, rank in ranks.items():
            self.lengths[rank], tokens[rank] = len(token), token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_at = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens in a row."""
        return gathered(self.token_bytes, self.token_at[ids], self.lengths[ids])


class Codec:
    """Encodes texts with the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], cached: int = CACHED_SLICES) -> None:
        self.ranks, self.cached, self.splitter = ranks, cached, Splitter()
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, merged = array("q"), array("i")
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        order = np.argsort(np.frombuffer(keys, np.int64))
        self.pair_keys = np.frombuffer(keys, np.int64)[order]
        self.pair_ranks = np.frombuffer(merged, np.int32)[order]
        self.decoder = Decoder(ranks)
        self.lengths = self.decoder.lengths
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.counts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], NO_MERGE)

    def _merge_together(self, slices: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Merge many short slices, one merge of each at a time: ids of all in a row, and the
        number of each."""
        lengths = np.array([len(x) for x in slices])
        width = int(lengths.max())
        ids = np.full((len(slices), width), -1, np.int32)
        inside = np.arange(width)[None, :] < lengths[:, None]
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(slices), np.uint8)]
        ranks = self._ranks_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, width - 1)
        rows = np.arange(len(slices))
        out = ids.copy()
        while len(rows):
            at = ranks.argmin(1)
            lowest = ranks[np.arange(len(rows)), at]
            more = lowest < NO_MERGE
            done = rows[~more]
            out[done, : ids.shape[1]] = ids[~more]
            out[done, ids.shape[1] :] = -1
            rows, ids, ranks, at, lowest = rows[more], ids[more], ranks[more], at[more], lowest[more]
            if not len(rows):
                break
            every = np.arange(len(rows))
            columns = np.arange(ids.shape[1] - 1)[None, :]
            ids[every, at] = lowest
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), 1)
            if ids.shape[1] == 1:
                out[rows, :1], out[rows, 1:] = ids, -1
                break
            columns = columns[:, :-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), 1)
            for place in (at - 1, at):
                ok = (place >= 0) & (place < ranks.shape[1])
                ranks[every[ok], place[ok]] = self._ranks_of(
                    ids[every[ok], place[ok]], ids[every[ok], place[ok] + 1]
                )
        there = out >= 0
        return out[there], there.sum(1)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """Merge one slice with a heap of pairs and a linked list of parts."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        size = len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = []

        def push(i: int) -> None:
            j = after[i]
            if j < size:
                rank = int(self._ranks_of(np.array([ids[i]]), np.array([ids[j]]))[0])
                if rank < NO_MERGE:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        ranks = self._ranks_of(np.array(ids[:-1]), np.array(ids[1:]))
        for i in np.flatnonzero(ranks < NO_MERGE).tolist():
            heapq.heappush(heap, (int(ranks[i]), i, ids[i], ids[i + 1]))
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= size or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < size:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def _learn(self, slices: list[bytes]) -> None:
        ranks = [self.ranks.get(x) for x in slices]
        order = [x for x, rank in zip(slices, ranks) if rank is not None]
        ids = [np.array([rank for rank in ranks if rank is not None], np.int32)]
        counts = [np.ones(len(order), np.int64)]
        groups: dict[int, list[bytes]] = {}
        for piece, rank in zip(slices, ranks):
            if rank is None and len(piece) > LONG_SLICE:
                order.append(piece)
                ids.append(self._merge_long(piece))
                counts.append(np.array([len(ids[-1])]))
            elif rank is None:
                groups.setdefault((len(piece) + 3) // 4, []).append(piece)
        for members in groups.values():
            order += members
            merged, sizes = self._merge_together(members)
            ids.append(merged)
            counts.append(sizes)
        first = len(self.known)
        self.known.update(zip(order, range(first, first + len(order))))
        self.ids = np.concatenate([self.ids, *ids])
        self.starts = np.concatenate([self.starts, len(self.ids) - sum(map(len, ids)) + _starts(np.concatenate(counts))])
        self.counts = np.concatenate([self.counts, *counts])

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, the number of ids of each text, and the byte where
        each token begins in its text."""
        points = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in batch]
        end = np.array([0x110000], np.uint32)
        joined = np.concatenate([part for x in points for part in (x, end)])
        starts = self.splitter.starts(joined)
        wide = (joined >= 0x80).astype(np.int64) + (joined >= 0x800) + (joined >= 0x10000) + 1
        ends = joined == 0x110000
        wide[ends] = 0
        at = np.cumsum(wide) - wide
        begins = at[starts]
        raw = "".join(batch).encode()
        cuts = [*begins.tolist(), len(raw)]
        slices = [raw[a:b] for a, b in pairwise(cuts)]
        if len(self.known) > self.cached:
            self.forget()
        missing = [x for x in dict.fromkeys(slices) if x not in self.known]
        if missing:
            self._learn(missing)
        picked = np.fromiter(map(self.known.__getitem__, slices), np.int64, len(slices))
        counts = self.counts[picked]
        ids = gathered(self.ids, self.starts[picked], counts)
        per_text = np.zeros(len(batch), np.int64)
        text_of = np.cumsum(ends)[starts]
        np.add.at(per_text, text_of, counts)
        token_ends = np.cumsum(self.lengths[ids])
        offsets = token_ends - self.lengths[ids]
        text_at = at[ends]  # where each text ends, in bytes
        first = np.concatenate(([0], text_at[:-1]))
        offsets -= np.repeat(first, per_text)
        return ids, per_text, offsets


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def gathered(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs ``values[start : start + count]``, one after the other."""
    total = int(counts.sum())
    shift = starts - (np.cumsum(counts) - counts)
    return values[np.arange(total) + np.repeat(shift, counts)]


@lru_cache(maxsize=2)
def codec(path: str, cached: int) -> Codec:
    return Codec(read_ranks(path), cached)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def encode(
    docs: DataFrame,
    path: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    cached: int = CACHED_SLICES,
) -> DataFrame:
    """Token ids of whole texts: columns ``keep``, ``tokens`` and ``offsets``.

    One row per input row, repeated rows and NULL ids included. A NULL or empty text has no
    tokens. ``offsets`` are the bytes of the text where the tokens begin. Special tokens are
    ordinary text. Other columns are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, cached)
        for batch in chunks(batches, "__text", TEXT_AT_ONCE):
            ids, per_text, offsets = coder.encode(texts(batch, "__text"))
            ends = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, x.astype(np.int32)) for x in (ids, offsets)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *lists], [*keep, "tokens", "offsets"]
            )

    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(released(run), f"{fields}, tokens array<int>, offsets array<int>")


def _placed(
    coder: Decoder, ids: np.ndarray, counts: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, each token's where its offset says, and their ends."""
    lengths = coder.lengths[ids]
    owner = np.repeat(np.arange(len(counts)), counts)
    sizes = np.bincount(owner, lengths, len(counts)).astype(np.int64)
    starts = _starts(sizes)
    out = np.zeros(int(sizes.sum()), np.uint8)
    shift = offsets + starts[owner] - _starts(lengths)
    out[np.arange(len(out)) + np.repeat(shift, lengths)] = coder.decode(ids)
    return out, np.concatenate((starts, [len(out)])).astype(np.int32)


def _binaries(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(raw)]
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, buffers)


def coded(
    docs: DataFrame,
    path: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    cached: int = CACHED_SLICES,
) -> DataFrame:
    """``encode`` and ``decode`` in one step: columns ``keep``, ``tokens``, ``offsets`` and
    ``decoded``. A worker holds the ranks once, and tokens do not travel between the two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path, cached)
        for batch in chunks(batches, "__text", TEXT_AT_ONCE):
            ids, per_text, offsets = coder.encode(texts(batch, "__text"))
            ends = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, x.astype(np.int32)) for x in (ids, offsets)]
            decoded = _binaries(*_placed(coder.decoder, ids, per_text, offsets))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *lists, decoded], [*keep, "tokens", "offsets", "decoded"]
            )

    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(
        released(run), f"{fields}, tokens array<int>, offsets array<int>, decoded binary"
    )


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, ``tokens`` and ``decoded``, the bytes of the text.

    Each token's bytes are put where its offset says. NULL tokens give no bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = decoder(path)
        for whole in batches:
            sizes = pc.fill_null(pc.list_value_length(whole.column(len(keep))), 0)
            for batch in cut(whole, sizes.to_numpy(False), TOKENS_AT_ONCE):
                tokens, offsets = batch.column(len(keep)), batch.column(len(keep) + 1)
                counts = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(False)
                ids = tokens.flatten().to_numpy(False)
                decoded = _binaries(*_placed(coder, ids, counts, offsets.flatten().to_numpy(False)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], decoded], [*keep, "tokens", "decoded"]
                )

    source = encoded.select(*keep, "tokens", "offsets")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    return source.mapInArrow(released(run), f"{fields}, decoded binary")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of tokens and digests of its ids and of the decoded bytes.

    One row per input row, repeated rows and NULL ids included. A NULL or empty text has no
    tokens and the digests of nothing; a text of any length is encoded whole. An empty table
    gives none. Other columns are not read, whatever their names.
    """
    written = F.array_join(F.col("tokens").cast("array<string>"), ",")
    return coded(docs, path).select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
