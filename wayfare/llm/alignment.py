"""Which tokens of two tokenizers stand for the same bytes of a text.

Both tokenizers give a text's bytes back, so their tokens end at byte offsets of the same
text. Offsets where both end cut the tokens into groups. The ends are compared along a
diagonal: at the current shift between the two indices, slices of doubling length are compared
until one differs, so a stretch of one-to-one groups is jumped in few steps, and halving finds
where the stretch ends. The irregular group that follows is walked token by token until both
ends meet again, which gives the new shift.

All A-B pairs of a group are links. The number of documents that hold a pair linked is
counted over the whole corpus. Each task first folds the pairs of a chunk of texts, so a pair
that stands in every document is sent once per chunk, and the counts come back the same way.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, release, released, shared_path, texts

TEXT_AT_ONCE = 2 << 20  # bytes of text that are aligned together, or one longer text
LONG_WORD = 1_000  # longer words are merged by the library with a priority queue
LONG_TEXT = 500_000
LARGE_GROUP = 1 << 16  # links of a group that is folded by distinct ids first
# Fixed value: the split pattern of byte-level vocabularies.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Tokenizer:
    """``encode`` gives the ids of texts, ``pieces`` the bytes of each id."""

    encode: Callable[[list[str]], list[list[int]]]
    pieces: list[bytes]

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(x) for x in self.pieces], np.int64)


def _byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the
    characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + n): b for n, b in enumerate(rest)}


@lru_cache(maxsize=2)
def byte_level(path: str) -> Tokenizer:
    """The tokenizer of a JSON file with a byte-level vocabulary; texts get a space in front.

    If merges come in the order of their ids, as usual, the same ids are found much faster
    with the entries as ranks. Texts with very long words, for which that takes quadratic time,
    and other files go through the library of the format.
    """
    import tiktoken
    import tokenizers

    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    special = {token["id"] for token in made["added_tokens"]}
    byte_of = _byte_of_character()
    vocabulary = made["model"]["vocab"]
    entries = {i: bytes(map(byte_of.__getitem__, x)) for x, i in vocabulary.items() if i not in special}
    pieces = [entries.get(i, b"") for i in range(max(entries) + 1)]  # special tokens never occur
    library = tokenizers.Tokenizer.from_file(path)
    library.encode_special_tokens = True

    def slow(text: str) -> list[int]:
        return library.encode(text, add_special_tokens=False).ids

    merges = [m if isinstance(m, list) else m.split(" ") for m in made["model"]["merges"]]
    made_ids = [vocabulary["".join(m)] for m in merges]
    in_order = all(a < b for a, b in zip(made_ids, made_ids[1:])) and made["normalizer"] is None
    if not in_order or made["pre_tokenizer"].get("type") != "ByteLevel":
        return Tokenizer(lambda batch: [slow(" " + x) for x in batch], pieces)
    fast = tiktoken.Encoding(
        "entries", pat_str=SPLIT, mergeable_ranks={p: i for i, p in entries.items()}, special_tokens={}
    )

    def encode(batch: list[str]) -> list[list[int]]:
        return [slow(" " + x) if _long(x) else fast.encode_ordinary(" " + x) for x in batch]

    return Tokenizer(encode, pieces)


def _long(text: str) -> bool:
    if len(text) <= LONG_WORD:
        return False
    return len(text) > LONG_TEXT or max(map(len, text.split()), default=0) > LONG_WORD


@lru_cache(maxsize=2)
def pieces_of_words(path: str) -> Tokenizer:
    """The tokenizer of a model of pieces, which puts a space in front itself."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        pieces.append(raw)
    return Tokenizer(lambda batch: model.encode(batch, num_threads=1), pieces)


def inner_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Indices of the ends in ``a`` and in ``b`` that do not end a group.

    Both are increasing and have their last value in common.
    """
    in_a: list[int] = []
    in_b: list[int] = []
    size = len(a)
    a, b = [*a, -1], [*b, -2]  # beyond the last value nothing is equal
    i = j = 0
    while i < size:
        if a[i] == b[j]:
            i += 1
            j += 1
            width = 1
            while a[i : i + width] == b[j : j + width]:
                i += width
                j += width
                width *= 2
            while width > 1:  # the stretch ends inside the slice that differed
                width >>= 1
                if a[i : i + width] == b[j : j + width]:
                    i += width
                    j += width
            if i >= size:
                break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                in_a.append(i)
                i += 1
                x = a[i]
            else:
                in_b.append(j)
                j += 1
                y = b[j]
        i += 1
        j += 1
    return in_a, in_b


@dataclass(frozen=True)
class Side:
    """Tokens of one tokenizer: ids of all texts in a row, and of each the group it is in."""

    ids: np.ndarray
    group: np.ndarray
    last: np.ndarray  # whether a token is the last of its group
    per_text: np.ndarray
    per_group: np.ndarray


@dataclass(frozen=True)
class Aligned:
    """The groups of some texts; texts without tokens have none."""

    a: Side
    b: Side
    groups: np.ndarray  # of each text

    @property
    def text_of_group(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.groups)), self.groups)


def _side(ids: np.ndarray, per_text: np.ndarray, inner: list[int]) -> Side:
    last = np.ones(len(ids), bool)
    last[inner] = False
    group = np.cumsum(last) - last
    return Side(ids, group, last, per_text, np.bincount(group, minlength=int(last.sum())))


def align(batch: list[str], first: Tokenizer, second: Tokenizer) -> Aligned:
    """Align the tokens of some texts. A text that is empty, or that one of the tokenizers does
    not give back byte by byte with a space in front, has no tokens."""
    a_tokens, b_tokens = first.encode(batch), second.encode(batch)
    for n, text in enumerate(batch):
        raw = (" " + text).encode()
        pieces = (
            b"".join(map(first.pieces.__getitem__, a_tokens[n])),
            b"".join(map(second.pieces.__getitem__, b_tokens[n])),
        )
        if not text or pieces[0] != raw or pieces[1] != raw:
            a_tokens[n], b_tokens[n] = [], []
    per_text, ids, ends = [], [], []
    for tokens, lengths in ((a_tokens, first.lengths), (b_tokens, second.lengths)):
        per_text.append(np.fromiter(map(len, tokens), np.int64, len(tokens)))
        ids.append(np.fromiter(chain.from_iterable(tokens), np.int64, int(per_text[-1].sum())))
        ends.append(np.cumsum(lengths[ids[-1]]).tolist())
    # A text ends for both at the same byte, so all texts can be aligned in one go.
    a, b = map(_side, ids, per_text, inner_ends(*ends))
    text_of = np.repeat(np.arange(len(batch)), a.per_text)
    return Aligned(a, b, np.bincount(text_of[a.last], minlength=len(batch)))


def links(aligned: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, pair (id of A in the upper 32 bits, id of B in the lower) and number of links of
    every pair that a text holds, in this order."""
    a, b = aligned.a, aligned.b
    text_of = aligned.text_of_group
    starts_a = np.cumsum(a.per_group) - a.per_group
    starts_b = np.cumsum(b.per_group) - b.per_group
    product = a.per_group * b.per_group
    large = np.flatnonzero(product > LARGE_GROUP)
    sizes = b.per_group[a.group]
    sizes[np.isin(a.group, large)] = 0
    of = np.repeat(np.arange(len(a.ids)), sizes)
    step = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    group = a.group[of]
    texts_, pairs = text_of[group], a.ids[of] << 32 | b.ids[starts_b[group] + step]
    times = np.ones(len(pairs), np.int64)
    for g in large.tolist():
        left, n = np.unique(a.ids[starts_a[g] : starts_a[g] + a.per_group[g]], return_counts=True)
        right, m = np.unique(b.ids[starts_b[g] : starts_b[g] + b.per_group[g]], return_counts=True)
        pairs = np.concatenate((pairs, (left[:, None] << 32 | right[None, :]).ravel()))
        times = np.concatenate((times, (n[:, None] * m[None, :]).ravel()))
        texts_ = np.concatenate((texts_, np.full(len(left) * len(right), text_of[g])))
    if not len(pairs):
        return texts_, pairs, times
    if len(aligned.groups) < 1 << 16 and int(a.ids.max()) < 1 << 24 and int(b.ids.max()) < 1 << 23:
        keys = texts_ << 47 | (pairs >> 32) << 23 | pairs & 0xFFFFFFFF
        order = np.argsort(keys, kind="stable")
    else:
        order = np.lexsort((pairs, texts_))
    texts_, pairs, times = texts_[order], pairs[order], times[order]
    new = np.concatenate(([True], (pairs[1:] != pairs[:-1]) | (texts_[1:] != texts_[:-1])))
    return texts_[new], pairs[new], np.add.reduceat(times, np.flatnonzero(new))


def _written(ids: int, ends: tuple[str, str]) -> np.ndarray:
    """Each id as text, followed by the first or, ``ids`` places later, the second ending."""
    return np.array([f"{i}{end}".encode() for end in ends for i in range(ids)])


class Printer:
    """Groups of a text as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, first: Tokenizer, second: Tokenizer) -> None:
        self.sizes = len(first.pieces), len(second.pieces)
        self.marks = _written(self.sizes[0], (",", "|")), _written(self.sizes[1], (",", ";"))
        self.width = max(x.dtype.itemsize for x in self.marks)
        self.marks = [x.astype(f"S{self.width}") for x in self.marks]

    def lines(self, aligned: Aligned) -> list[bytes]:
        a, b = aligned.a, aligned.b
        out = np.empty(len(a.ids) + len(b.ids), f"S{self.width}")
        before_b = np.cumsum(b.per_group) - b.per_group
        through_a = np.cumsum(a.per_group)
        out[np.arange(len(a.ids)) + before_b[a.group]] = self.marks[0][a.ids + self.sizes[0] * a.last]
        out[np.arange(len(b.ids)) + through_a[b.group]] = self.marks[1][b.ids + self.sizes[1] * b.last]
        raw = out.tobytes()
        ends = np.cumsum(a.per_text + b.per_text) * self.width
        starts = np.concatenate(([0], ends[:-1]))
        return [raw[s:e].translate(None, b"\0")[:-1] for s, e in zip(starts.tolist(), ends.tolist())]


@lru_cache(maxsize=1)
def _tools(first: str, second: str) -> tuple[Tokenizer, Tokenizer, Printer]:
    a, b = byte_level(first), pieces_of_words(second)
    return a, b, Printer(a, b)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: type) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(values.astype(kind)))


def groups(docs: DataFrame, first: str, second: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep``, then ``a_ids`` and ``b_ids``, the tokens of both, and ``a_sizes`` and
    ``b_sizes``, how many of them each group has.

    ``first`` is the file of a byte-level vocabulary, ``second`` that of a model of pieces. One
    row per input row, repeated rows and NULL ids included; texts that are NULL, empty or not
    given back by both have empty lists. Other columns are not read. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, _ = _tools(first, second)
        for batch in chunks(batches, "__text", TEXT_AT_ONCE):
            found = align(texts(batch, "__text"), a, b)
            lists = [_lists(s.ids, s.per_text, np.int32) for s in (found.a, found.b)]
            lists += [_lists(s.per_group, found.groups, np.int32) for s in (found.a, found.b)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *lists], [*keep, "a_ids", "b_ids", "a_sizes", "b_sizes"]
            )

    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    made = ", ".join(f"{name} array<int>" for name in ("a_ids", "b_ids", "a_sizes", "b_sizes"))
    return source.mapInArrow(released(run), f"{fields}, {made}")


_HELD = (
    "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
    "pairs array<bigint>, times array<bigint>, of_chunk array<struct<pair: bigint, held: bigint>>"
)
_HELD_NAMES = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times", "of_chunk"]


def _held(docs: DataFrame, first: str, second: str, text: str) -> DataFrame:
    """Per document its pairs with their numbers of links; the first document of a chunk has in
    ``of_chunk`` the pairs of the chunk, with the number of its documents that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, printer = _tools(first, second)
        chunk = TaskContext.get().partitionId() << 33
        for batch in chunks(batches, "__text", TEXT_AT_ONCE):
            found = align(texts(batch, "__text"), a, b)
            text_of, pairs, times = links(found)
            rows = batch.num_rows
            per_text = np.bincount(text_of, minlength=rows)
            lines = printer.lines(found)
            distinct, held = np.unique(pairs, return_counts=True)
            whole = pa.StructArray.from_arrays([pa.array(distinct), pa.array(held.astype(np.int64))], ["pair", "held"])
            at = pa.array([0, *[len(distinct)] * rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows, chunk)),
                    batch.column(0),
                    pa.array(found.a.per_text),
                    pa.array(found.b.per_text),
                    pa.array(found.groups.astype(np.int64)),
                    pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in lines]),
                    _lists(pairs, per_text, np.int64),
                    _lists(times, per_text, np.int64),
                    pa.ListArray.from_arrays(at, whole),
                ],
                _HELD_NAMES,
            )
            chunk += 1

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("__text"))
    made = source.mapInArrow(released(run), _HELD)
    path = shared_path(docs.sparkSession)
    made.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(made.schema).parquet(path)


def pair_counts(held: DataFrame) -> DataFrame:
    """``pair``, ``held`` (documents that hold it linked) and ``best`` (no pair of the same id of
    A is held by more). A pair reaches the shuffle once per chunk."""
    each = held.select(F.inline("of_chunk"))
    counts = each.groupBy("pair").agg(F.sum("held").alias("held"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("held").alias("top"))
    return counts.join(top, "a").select("pair", "held", (F.col("held") == F.col("top")).alias("best"))


def _scored(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a chunk with what the pairs of that chunk count."""
    pairs = right.column("pair").to_numpy()
    order = np.argsort(pairs)
    pairs = pairs[order]
    held, best = right.column("held").to_numpy()[order], right.column("best").to_numpy()[order]
    lists = left.column("pairs").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    at = np.searchsorted(pairs, lists.flatten().to_numpy(False))
    times = left.column("times").combine_chunks().flatten().to_numpy(False)
    row = np.repeat(np.arange(left.num_rows), sizes)

    def total(values: np.ndarray) -> pa.Array:
        sums = np.zeros(left.num_rows, np.int64)
        np.add.at(sums, row, values)
        return pa.array(sums)

    sums = [total(times), total(times * best[at] if len(at) else times), total(times * held[at] if len(at) else times)]
    names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    out = [left.column(n).combine_chunks() for n in names]
    release()
    return pa.table([*out, *sums], [*names, "n_links", "n_best", "count_sum"])


def digests(docs: DataFrame, first: str, second: str, text: str = "text") -> DataFrame:
    """Per document the sizes of its alignment, what its links count in the whole corpus, and a
    digest of its groups.

    Columns ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row
    per input row. Rows that repeat an id or a text are documents of their own and count as
    such, and so are rows with a NULL id. A text that is NULL, empty or not given back by both
    tokenizers has zeros and an empty digest, and adds nothing to the counts. An empty table
    gives none. Other columns are not read, whatever their names. Among pairs of one id of A
    that are held equally often all are best.
    """
    held = _held(docs, first, second, text)
    counts = pair_counts(held)
    asked = held.select(F.col("chunk").alias("asker"), F.inline("of_chunk")).select("asker", "pair")
    answers = asked.join(counts, "pair").select("asker", "pair", "held", "best")
    rows = held.drop("of_chunk")
    scored = rows.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(
        _scored,
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
        "n_links bigint, n_best bigint, count_sum bigint",
    )
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
