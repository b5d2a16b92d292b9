"""Words that differ by one letter, and the usual form of the rare ones.

The vocabulary is a minimised acceptor; composed with a transducer that makes exactly one edit,
and with the acceptor again, it accepts the pairs of words that are one edit apart. The
composition is enumerated apart for each part of the vocabulary that an initial state leads to.

A part is what stands behind one prefix, or, for the acceptor read backwards, before one suffix.
Two words one edit apart share the first or the last half of the shorter one's letters: the
first, if they first differ behind it, else the last. So a word goes to four parts: by its first
and by its last half, together with words as long as itself and with those one letter longer,
and in the same way with those one letter shorter. A part of more than ``MOST`` words is divided
by the halves of what is left of them, until it is small; what is left gets shorter by half each
time, and few words can share all but two letters. No pair is found twice.

A part is worked on by one task. Only the number of near words of each word and the best of
them leave it, never the pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, released, stored, texts

LEAST_LETTERS, LEAST_TIMES, FORM_FACTOR = 7, 2, 10
DELETED_OF = 31  # one in so many words of a text loses a letter
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
WORDS_AT_ONCE = 300_000  # distinct words that a task counts before it sends them on
MOST = 20_000  # words of a part


def letter_runs(text: str, doc_id: str | None) -> Counter[str]:
    """The words of a text with their number: runs of letters, A-Z in lower case. Where the
    checksum of id and run says so, the run has lost a letter; without an id none has."""
    out: Counter[str] = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUN.findall(text.encode().lower().decode())).items():
        if doc_id is not None:
            h = zlib.crc32(run.encode(), start)
            if h % DELETED_OF == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LETTERS:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word`` and ``n`` of the words that occur ``LEAST_TIMES`` at least. A word reaches the
    shuffle once per ``WORDS_AT_ONCE`` words of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(met), pa.string()), pa.array(list(met.values()), pa.int64())], ["word", "n"]
            )

        met: Counter[str] = Counter()
        for batch in chunks(batches, "__text"):
            for doc_id, whole in zip(batch.column("__id").to_pylist(), texts(batch, "__text")):
                for word, n in letter_runs(whole, doc_id).items():
                    met[word] += n
                if len(met) >= WORDS_AT_ONCE:
                    yield sent()
                    met = Counter()
        yield sent()

    source = docs.select(F.col("doc_id").cast("string").alias("__id"), F.col(text).alias("__text"))
    counted = source.mapInArrow(released(run), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TIMES)


# --- acceptors ----------------------------------------------------------------------


class Acceptor:
    """The minimised automaton of some words, built from their sorted list.

    ``edges[state]`` leads from letters to states, ``final`` says where words end. States that
    accept the same rests are one.
    """

    def __init__(self, words: list[str]) -> None:
        self.edges: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[{}, False, ""]]  # open states: edges, final, letter that leads here
        before = ""

        def close(depth: int) -> None:
            while len(path) > depth:
                edges, final, letter = path.pop()
                key = (final, *edges.items())
                state = known.setdefault(key, len(self.edges))
                if state == len(self.edges):
                    self.edges.append(edges)
                    self.final.append(final)
                if path:
                    path[-1][0][letter] = state

        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            close(shared + 1)
            path.extend([{}, False, letter] for letter in word[shared:])
            path[-1][1] = True
            before = word
        close(1)
        edges, final, _ = path.pop()
        self.edges.append(edges)
        self.final.append(final)
        self.start = len(self.edges) - 1


Path = tuple  # letters read so far, the last first: (before, letter), or () for none


def _letters(path: Path) -> str:
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out))


def _rests(left: Acceptor, right: Acceptor, p: int, q: int, path: Path) -> Iterator[Path]:
    """What both accept from ``p`` and ``q`` on, behind ``path``."""
    todo = [(p, q, path)]
    while todo:
        p, q, path = todo.pop()
        if left.final[p] and right.final[q]:
            yield path
        edges = right.edges[q]
        for letter, state in left.edges[p].items():
            if letter in edges:
                todo.append((state, edges[letter], (path, letter)))


def replaced(words: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs of words that differ in one letter, each once: the acceptor composed with one
    replacement and itself."""
    todo: list[tuple[int, Path]] = [(words.start, ())]
    while todo:
        state, path = todo.pop()
        edges = list(words.edges[state].items())
        for i, (a, p) in enumerate(edges):
            todo.append((p, (path, a)))
            for b, q in edges[i + 1 :]:
                for rest in _rests(words, words, p, q, ()):
                    before, after = _letters(path), _letters(rest)
                    yield before + a + after, before + b + after


def inserted(short: Acceptor, long: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs of a word and the same with one more letter, each once: both acceptors composed
    with one insertion, at the last of the places that give the same."""
    todo: list[tuple[int, int, Path]] = [(short.start, long.start, ())]
    while todo:
        p, q, path = todo.pop()
        nexts = short.edges[p]
        for b, then in long.edges[q].items():
            if b in nexts:
                todo.append((nexts[b], then, (path, b)))
            if short.final[p] and long.final[then]:
                before = _letters(path)
                yield before, before + b
            for a, state in nexts.items():
                if a != b and a in long.edges[then]:
                    for rest in _rests(short, long, state, long.edges[then][a], ((), a)):
                        before, after = _letters(path), _letters(rest)
                        yield before + after, before + b + after


# --- parts --------------------------------------------------------------------------


def _halves(rows: DataFrame) -> DataFrame:
    """Divide parts by the first and by the last half of what is left of their words.

    ``base`` is the length of the shorter words' rest; the longer words' is one more. ``closed``
    parts leave out pairs that differ by a letter at the end of the rest only: those share the
    first half, and another part has them.
    """
    half = F.floor(F.col("base") / 2).cast("int")
    tail = F.col("base") - half
    length = F.length("rest")
    first = rows.select(
        F.concat("key", F.lit(">"), F.substring("rest", F.lit(1), half)).alias("key"),
        F.substring("rest", half + 1, length).alias("rest"),
        tail.alias("base"),
        "closed",
        "word",
        "n",
    )
    last = rows.select(
        F.concat("key", F.lit("<"), F.substring("rest", length - tail + 1, tail)).alias("key"),
        F.substring("rest", F.lit(1), length - tail).alias("rest"),
        half.alias("base"),
        F.lit(True).alias("closed"),
        "word",
        "n",
    )
    return first.unionByName(last)


def parts_of(words: DataFrame) -> DataFrame:
    """``key``, ``rest``, ``base``, ``closed``, ``word`` and ``n``: the words of each part, in
    parts of at most ``MOST`` words or with rests of two letters."""
    length = F.length("word")
    bases = F.array(length, length - 1)  # with longer words, and with shorter ones
    each = words.select("word", "n", F.explode(bases).alias("base")).where(F.col("base") >= LEAST_LETTERS)
    whole = each.select(
        F.col("base").cast("string").alias("key"),
        F.col("word").alias("rest"),
        "base",
        F.lit(False).alias("closed"),
        "word",
        "n",
    )
    todo, done = stored(_halves(whole)), []
    while True:
        sizes = todo.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.max("base").alias("left"))
        large = stored(sizes.where((F.col("size") > MOST) & (F.col("left") > 1)).select("key"))
        if not large.limit(1).count():
            done.append(todo)
            break
        done.append(todo.join(large, "key", "left_anti"))
        todo = stored(_halves(todo.join(large, "key", "left_semi")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


Met = tuple[str, int]  # a word and its number


class _Near:
    """Number of near words and the best of them, of each word of a part."""

    def __init__(self) -> None:
        self.count: Counter[str] = Counter()
        self.best: dict[str, Met] = {}

    def add(self, word: str, other: Met) -> None:
        self.count[word] += 1
        best = self.best.get(word)
        if best is None or other[1] > best[1] or (other[1] == best[1] and other[0] < best[0]):
            self.best[word] = other


def near_in_part(rows: list[tuple[str, str, int]], base: int, closed: bool) -> _Near:
    """Near words of a part given as (rest, word, n)."""
    out = _Near()
    short = {rest: (word, n) for rest, word, n in rows if len(rest) == base}
    long = {rest: (word, n) for rest, word, n in rows if len(rest) != base}
    if not short:
        return out
    acceptor = Acceptor(sorted(short))
    if len(short) > 1:
        for a, b in replaced(acceptor):
            out.add(short[a][0], short[b])
            out.add(short[b][0], short[a])
    if long:
        for a, b in inserted(acceptor, Acceptor(sorted(long))):
            if not (closed and b.startswith(a)):
                out.add(short[a][0], long[b])
                out.add(long[b][0], short[a])
    return out


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (``n`` and ``word``) of all words that have near ones."""
    dealt = parts_of(words).repartition("key").sortWithinPartitions("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, rows = None, None, []

        def near() -> list[tuple[str, int, int, str]]:
            found = near_in_part(rows, *state)
            return [(w, n, found.best[w][1], found.best[w][0]) for w, n in found.count.items()]

        def sent(out: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "best_n", "best"]
            )

        out: list[tuple[str, int, int, str]] = []
        for batch in batches:
            for at, rest, base, closed, word, n in zip(*[c.to_pylist() for c in batch.columns]):
                if at != key:
                    if len(rows) > 1:
                        out += near()
                    key, state, rows = at, (base, closed), []
                rows.append((rest, word, n))
            yield sent(out)
            out = []
        if len(rows) > 1:
            out += near()
        yield sent(out)

    found = dealt.mapInArrow(released(run), "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def roots_of(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: where following ``form`` ends. Each round doubles the steps; as
    numbers grow tenfold with each step, few rounds are enough."""
    now = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stored(
            now.join(then, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            )
        )
        if not further.where("moved").limit(1).count():
            return now
        now = further.select("word", "root")


def variants(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n``: a row for each word.

    Words are runs of letters ([A-Za-z] and U+00C0 to U+00FF, A-Z in lower case) of whole texts
    that have 7 letters at least, after some have lost one (see ``letter_runs``), and occur twice
    at least. ``n_near`` is the number of words exactly one letter more, less or different.
    ``form`` is the near word that occurs most often (of equals, the first in code-point order),
    if it occurs ten times as often or more; ``root`` follows forms to the last, and is the word
    itself if it has none. Repeated rows count as often as they are there. A NULL or empty text
    has no words; in rows without an id no word loses a letter. An empty table gives none. Other
    columns are not read, whatever their names.
    """
    words = stored(vocabulary(docs, text))
    named = words.join(near_words(words), "word", "left")
    fits = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    named = stored(
        named.select(
            "word",
            F.when(fits, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(fits, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = roots_of(named.where(F.col("form").isNotNull()))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
