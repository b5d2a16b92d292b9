import hashlib
import random
from collections import Counter

import duckdb
import pytest

from wayfare.llm import substrings
from wayfare.llm.queries import oracle_sql, queries


def by_hand(docs, window):
    """Per row its words, and a flag for each that a repeated window covers."""
    split = [(text or "").encode().split() for _, text in docs]
    seen = Counter(tuple(w[p : p + window]) for w in split for p in range(len(w) - window + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for p in range(len(words) - window + 1):
            if seen[tuple(words[p : p + window])] > 1:
                gone[p : p + window] = [True] * window
        out.append((words, gone))
    return out


def check(spark, docs, window, parts=3):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    rows = substrings.without_repeats(frame, window).collect()
    found = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in rows), key=str)
    expected = [
        (doc_id, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode())
        for (doc_id, _), (words, gone) in zip(docs, by_hand(docs, window))
    ]
    assert found == sorted(expected, key=str)
    return sum(r[2] for r in expected)


def test_query_against_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS FROM read_parquet('{sf_dir}/documents.parquet')")
    frame = queries()["op12_substring_dedup"](spark, sf_dir)
    expected = connection.sql(oracle_sql()["op12_substring_dedup"])
    assert frame.columns == expected.columns
    found = [tuple(r) for r in frame.collect()]
    assert sorted(found) == sorted(expected.fetchall())
    assert any(r[2] for r in found) and any(r[1] > r[2] for r in found)


@pytest.mark.parametrize("window", [35, 4, 5, 2])
@pytest.mark.parametrize("small", [False, True])
def test_random_texts(spark, monkeypatch, window, small):
    """Passages of few words, cut out of each other and put together at odd places."""
    if small:  # a parcel for every few texts
        monkeypatch.setattr(substrings, "sizes_for", lambda words: (7, 40))
        monkeypatch.setattr(substrings, "chunks", lambda batches, column: (
            b.slice(n, 1) for b in batches for n in range(b.num_rows)))
    rng = random.Random(window)
    vocabulary = [f"w{n}" for n in range(4 if window < 35 else 400)]
    passages = [rng.choices(vocabulary, k=rng.randint(1, 3 * window)) for _ in range(12)]
    docs = []
    for n in range(60):
        words = []
        for _ in range(rng.randint(0, 4)):
            passage = rng.choice(passages)
            start = rng.randrange(len(passage))
            words += passage[start : start + rng.randint(1, 3 * window)]
            words += rng.choices(vocabulary, k=rng.randint(0, 3))
        docs.append((n, " ".join(words)))
    docs += [(60, docs[3][1]), (60, docs[3][1]), (None, docs[5][1])]
    assert check(spark, docs, window) > 0


def test_periodic_text_and_shared_ends(spark):
    docs = [(1, "la " * 100), (2, "x " + "a b c " * 30), (3, "y " + "a b c " * 12)]
    docs += [(4, " ".join(f"q{n}" for n in range(34))), (5, " ".join(f"q{n}" for n in range(35)))]
    docs += [(6, "z " + " ".join(f"q{n}" for n in range(36)))]
    assert check(spark, docs, 35) > 0


def test_edges(spark, edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check(spark, rows, 35)
    assert substrings.digests(edge_docs).count() == edge_docs.count()  # with clashing columns
    done = substrings.without_repeats(edge_docs, keep=("doc_id", "score", "block", "kept"))
    assert done.columns == ["doc_id", "score", "block", "kept", "n_words", "n_removed", "kept_text"]
    assert done.count() == edge_docs.count()
    odd = [(1, "a b c d\x1ce\x85f " * 40), (2, "A b " * 40), (3, "a b " * 40)]
    check(spark, odd, 35)


def test_empty_table(spark):
    assert check(spark, [], 35, 1) == 0


def test_shuffled_join_gives_the_same(spark, monkeypatch, tables):
    docs = tables("documents").select("doc_id", "text")
    sent = sorted(map(tuple, substrings.digests(docs).collect()))
    monkeypatch.setattr(substrings, "BROADCAST_SPANS", -1)
    assert sorted(map(tuple, substrings.digests(docs).collect())) == sent


def test_packing():
    values = [0, 1, 255, 256, 2**39]
    assert substrings._unpack(substrings._pack(values, 5), 5).tolist() == values
    assert substrings._unpack(b"", 5).tolist() == []


def test_messages_do_not_grow_with_copies(spark):
    """A passage that all texts share is sent once per parcel."""
    passage = " ".join(f"p{n}" for n in range(60))
    raws = [f"{passage} t{n}".encode() for n in range(500)]
    parcel = substrings._Parcel(0, 35, 64)
    parcel.add(raws)
    sent = sum(len(r[3]) // substrings.HASH for r in parcel.messages() if r[1] == substrings.PLACES)
    assert sent == 43 + 500  # the shared places, and those with the last word of a text
    assert hashlib.md5(raws[0]).digest() in parcel.rank
