"""Quality rules and a linear-chain conditional random field over the lines of a text.

Base rules count words, symbols, repeated lines and repeated 5-word windows. For the rest, a
conditional random field with two states marks each line as content or boilerplate: Viterbi
decoding finds the best sequence, and the share of words in content lines decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import chunks, held_out, released, texts

SYMBOLS = b"#*$%&|<>"  # fixed value of the contract
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 5
SAMPLE_OF_EACH = 2500  # labelled documents of each quality that the fit uses
SAMPLE_CHARS = 20_000  # longest of them
SAMPLE_LINES = 64  # most lines of them
LEAST_CONTENT = 0.5  # share of words in content lines that a kept text has
BOILERPLATE, CONTENT = 0, 1
ASCII_UPPER = bytes(range(65, 91))
ASCII_LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
MENTIONS = re.compile(rb"https?:|www\.|@|licen[sc]e|copyright|all rights|cookie|click|subscribe", re.I)

#: A feature is whether a measure of the line is at least a bound.
BOUNDS = {
    "words": (3, 8, 20, 60),
    "symbols": (0.001, 0.02, 0.05, 0.15),
    "pipes": (0.02, 0.1),
    "repeated": (0.3, 0.5, 0.7, 0.85),  # 1 - distinct words / words
    "next_same": (0.1, 0.3, 0.6),  # words equal to the one before
    "upper": (0.1, 0.3, 0.6),
    "digits": (0.05, 0.2, 0.5),
    "marks": (0.02, 0.06, 0.15),  # exclamation and question marks
    "long_words": (12, 25),  # mean bytes of a word
    "no_stop": (0.5,),
    "mentions": (0.5,),
    "seen": (0.5,),  # equal to an earlier line
}
FEATURES = 1 + sum(map(len, BOUNDS.values()))
_FLAT_BOUNDS = np.array([b for bounds in BOUNDS.values() for b in bounds])
_MEASURE_OF = np.array([i for i, bounds in enumerate(BOUNDS.values()) for _ in bounds])


def measures(line: bytes, words: list[bytes], seen: bool) -> tuple[float, ...]:
    """What the features of a line are made from, in the order of ``BOUNDS``."""
    size, count = max(len(line), 1), max(len(words), 1)
    share = lambda drop: (size - len(line.translate(None, drop))) / size
    upper, lower = share(ASCII_UPPER), share(ASCII_LOWER)
    return (
        len(words),
        share(SYMBOLS),
        line.count(b"|") / count,
        1 - len(set(words)) / count,
        sum(map(bytes.__eq__, words, words[1:])) / count,
        upper / max(upper + lower, 1e-9),
        share(DIGITS),
        share(b"!?"),
        sum(map(len, words)) / count,
        float(not words or words[-1][-1:] not in b".!?:;\"')"),
        float(bool(MENTIONS.search(line))),
        float(seen),
    )


def line_features(rows: list[tuple[float, ...]]) -> np.ndarray:
    values = np.array(rows, np.float64).reshape(-1, len(BOUNDS))
    on = values[:, _MEASURE_OF] >= _FLAT_BOUNDS
    return np.concatenate([np.ones((len(on), 1)), on], 1)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that occur at least twice."""
    if len(words) <= WINDOW:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    windows = len(ids) - WINDOW + 1
    base, key, top = len(number), ids[:windows], len(number)
    for j in range(1, WINDOW):
        if top * base >= 1 << 62:
            _, key = np.unique(key, return_inverse=True)
            top = windows
        key, top = key * base + ids[j : windows + j], top * base
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(windows, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    if not twice.any():
        return 0
    at = np.flatnonzero(twice)
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def describe(text: str) -> tuple[tuple[int, ...], list[tuple[float, ...]], list[int]]:
    """Base counts; measures and numbers of words of the lines that have a word."""
    raw = text.encode("utf-8", "surrogatepass")
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    duplicates, all_words, rows, sizes = 0, [], [], []
    for line in raw.split(b"\n"):
        words = line.split()
        if not words:
            continue
        again = line in seen
        duplicates += again
        seen.add(line)
        all_words += words
        rows.append(measures(line, words, again))
        sizes.append(len(words))
    base = (len(all_words), len(text) - spaces, symbols, duplicates, repeated_words(all_words))
    return base, rows, sizes


class Field:
    """Weights of the conditional random field: emission (features x 2), transition (2 x 2)."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray) -> None:
        self.emission, self.transition = emission, transition

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The best sequence of states; of equal ones that with more content."""
        scores = (features @ self.emission).tolist()
        (bb, bc), (cb, cc) = self.transition.tolist()
        b, c = scores[0]
        back = []
        for eb, ec in scores[1:]:
            from_b = (b + bb > c + cb, b + bc > c + cc)
            back.append(from_b)
            b, c = max(b + bb, c + cb) + eb, max(b + bc, c + cc) + ec
        state = CONTENT if c >= b else BOILERPLATE
        path = [state]
        for from_b in reversed(back):
            state = BOILERPLATE if from_b[state] else CONTENT
            path.append(state)
        return np.array(path[::-1])


def line_labels(field: Field, features: np.ndarray, sizes: np.ndarray, label: int) -> np.ndarray:
    """The states of a labelled document's lines: the best sequence, if the words in its content
    lines agree with the label; otherwise all lines carry the label."""
    path = field.viterbi(features)
    content = sizes[path == CONTENT].sum() >= LEAST_CONTENT * sizes.sum()
    return path if content == (label == CONTENT) else np.full(len(path), label)


def fit(sequences: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 60, passes: int = 2) -> Field:
    """The field from the features of lines, their numbers of words, and the label of the
    document they are in.

    Only documents are labelled; which of their lines are content is found out by turns (hard
    expectation maximisation). At first every line has the label of its document, and lines are
    judged one by one. Then each document's lines get their best sequence under the field so far,
    as far as it agrees with the label (see ``line_labels``), and the field, now with transitions,
    is fitted to these sequences. So a line of a good document that looks like those of bad ones
    becomes boilerplate, and a label can change inside a document.

    Likelihood is maximised with a small Gaussian prior; both labels count alike, and so does
    every document, however long. With one label only, or none, every line is content.
    """
    emission = np.zeros((FEATURES, 2))
    labels = np.array([y for _, _, y in sequences], int)
    if not 0 < labels.sum() < len(labels):
        emission[0, CONTENT] = 1.0
        return Field(emission, np.zeros((2, 2)))
    field = _fitted(sequences, [np.full(len(x), y) for x, _, y in sequences], rounds, False)
    for _ in range(passes):
        states = [line_labels(field, x, sizes, y) for x, sizes, y in sequences]
        field = _fitted(sequences, states, rounds, True)
    return field


def _fitted(
    sequences: list[tuple[np.ndarray, np.ndarray, int]], states: list[np.ndarray], rounds: int, chained: bool
) -> Field:
    """Maximum likelihood of the states of all lines; without chains transitions stay 0."""
    labels = np.array([y for _, _, y in sequences], int)
    longest = max(len(x) for x, _, _ in sequences)
    total = len(sequences)
    x = np.zeros((total, longest, FEATURES))
    mask = np.zeros((total, longest), bool)
    truth = np.zeros((total, longest, 2))
    pairs = np.zeros((total, 2, 2))
    for i, (rows, _, _) in enumerate(sequences):
        x[i, : len(rows)], mask[i, : len(rows)] = rows, True
        truth[i, np.arange(len(rows)), states[i]] = 1
        np.add.at(pairs[i], (states[i][:-1], states[i][1:]), 1)
    weight = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    lengths = mask.sum(1)
    scale = weight / lengths
    params = np.zeros(FEATURES * 2 + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        emission, transition = params[:-4].reshape(FEATURES, 2), params[-4:].reshape(2, 2)
        e = np.exp((s := x @ emission) - s.max(2, keepdims=True))
        move = np.exp(transition - transition.max())
        forward, backward = np.zeros_like(e), np.ones_like(e)
        forward[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for t in range(1, longest):
            nxt = (forward[:, t - 1] @ move) * e[:, t]
            nxt /= nxt.sum(1, keepdims=True)
            forward[:, t] = np.where(mask[:, t, None], nxt, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nxt = (backward[:, t + 1] * e[:, t + 1]) @ move.T
            nxt /= nxt.sum(1, keepdims=True)
            backward[:, t] = np.where(mask[:, t + 1, None], nxt, 1.0)
        state = forward * backward
        state /= state.sum(2, keepdims=True)
        joint = forward[:, :-1, :, None] * move * (e * backward)[:, 1:, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        joint *= mask[:, 1:, None, None]
        by_line = (truth - state * mask[:, :, None]) * scale[:, None, None]
        slope = np.concatenate(
            [
                np.einsum("itf,its->fs", x, by_line).ravel(),
                ((pairs - joint.sum(1)) * scale[:, None, None]).sum(0).ravel(),
            ]
        )
        slope -= 1e-4 * params
        if not chained:
            slope[-4:] = 0
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        params = params + 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * m / (np.sqrt(v) + 1e-8)
    return Field(params[:-4].reshape(FEATURES, 2), params[-4:].reshape(2, 2))


def learn(docs: DataFrame, labels: DataFrame) -> Field:
    """Fit on at most ``SAMPLE_OF_EACH`` labelled documents of each quality.

    They are the ones with the least hashes of their id among those that are not held out,
    not NULL, and within ``SAMPLE_CHARS`` and ``SAMPLE_LINES``. A row that repeats an id takes part
    if it is among the ``SAMPLE_OF_EACH`` rows with the least hashes of id and text.
    """
    marked = labels.select("doc_id", F.col("quality").alias("__quality")).where(
        F.col("__quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    usable = docs.select("doc_id", "text").where(
        F.length("text").between(1, SAMPLE_CHARS)
        & (F.size(F.split("text", "\n")) <= SAMPLE_LINES)
    )
    ids = usable.select("doc_id").join(marked, "doc_id")
    sequences = []
    for label in (0, 1):
        chosen = (
            ids.where(F.col("__quality") == label)
            .select("doc_id")
            .distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(SAMPLE_OF_EACH)
        )
        some = usable.join(F.broadcast(chosen), "doc_id")
        least = some.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"), "text").limit(SAMPLE_OF_EACH)
        for row in least.collect():
            _, rows, sizes = describe(row["text"])
            if rows:
                sequences.append((line_features(rows), np.array(sizes), label))
    return fit(sequences)


def judge(
    docs: DataFrame, field: Field, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Columns ``keep``, the base counts, ``base_failed``, ``content_share`` and ``kept``.

    A NULL or empty text has no words: all counts 0, failed, share 0, not kept. Repeated
    rows and NULL keys stay. Other columns are not read. No shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in chunks(batches, "__text"):
            counts, shares = [], []
            for value in texts(batch, "__text"):
                base, rows, sizes = describe(value)
                counts.append(base)
                share = 0.0
                if rows:
                    content = model.viterbi(line_features(rows)) == CONTENT
                    share = float(np.array(sizes)[content].sum() / base[0])
                shares.append(share)
            columns = np.array(counts, np.int64).reshape(-1, len(names)).T
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(x) for x in columns), pa.array(shares, pa.float64())],
                [*keep, *names, "content_share"],
            )

    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[:-1])
    counted = ", ".join(f"{x} bigint" for x in names)
    found = source.mapInArrow(released(run), f"{fields}, {counted}, content_share double")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("content_share") >= LEAST_CONTENT)
    )


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with a field learnt from ``labels`` (``doc_id`` and ``quality``).

    One row per document, those with a NULL or repeated id, a NULL or empty text (all counts 0,
    not kept) or a very long one too. Labels that are NULL, of unknown documents or missing
    altogether teach nothing; without both of them the base rules alone decide. An empty table
    gives no rows. Other columns are not read.
    """
    return judge(docs, learn(docs, labels))
