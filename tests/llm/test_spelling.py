import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest
from hypothesis import given
from hypothesis import strategies as st

from wayfare.llm import spelling
from wayfare.llm.queries import queries

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(docs):
    """The words of the contract, run by run."""
    met = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            met[run] += 1
    return {w: n for w, n in met.items() if len(w) >= 7 and n >= 2}


def by_hand(words):
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for size, members in by_length.items():
        pairs = list(combinations(members, 2))
        pairs += [(a, b) for a in members for b in by_length.get(size + 1, ())]
        for a, b in pairs:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_query_against_pairwise_edits(spark, sf_dir, tables):
    docs = [(r["doc_id"], r["text"]) for r in tables("documents").collect()]
    expected = by_hand(counted(docs))
    assert found(queries()["op11_spelling_variants"](spark, sf_dir)) == expected
    assert any(r[1] for r in expected)


def of_words(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.fixture
def dense():
    """Words over two letters, in which nearly every word has many near ones."""
    rng = random.Random(3)
    words = {"".join(rng.choices("ab", k=rng.randint(7, 10))): rng.choice([2, 3, 20, 30, 400]) for _ in range(500)}
    words |= {"a" * k: 10 ** (k - 6) for k in range(7, 14)}  # a chain of forms
    return words | {"x" * 300 + c: 5 for c in "abc"} | {"x" * 300: 60, "é" * 7: 9, "è" + "é" * 6: 90}


@pytest.mark.parametrize("most", [20_000, 10, 1])
def test_parts_give_every_pair_once(spark, monkeypatch, dense, most):
    monkeypatch.setattr(spelling, "MOST", most)
    rows = spelling.near_words(of_words(spark, dense)).collect()
    expected = {r[0]: r for r in by_hand(dense) if r[4]}
    assert {r["word"]: r["n_near"] for r in rows} == {w: r[4] for w, r in expected.items()}
    forms = {r["word"]: r["best"]["word"] for r in rows if -r["best"]["less"] >= 10 * dense[r["word"]]}
    assert forms == {w: r[1] for w, r in expected.items() if r[1]}


def test_chains_of_forms_end_at_the_root(spark):
    chain = [(f"w{n:02}", f"w{n + 1:02}") for n in range(19)] + [("lone", "w19"), ("pair", "other")]
    frame = spark.createDataFrame(chain, "word string, form string")
    roots = {r["word"]: r["root"] for r in spelling.roots_of(frame).collect()}
    assert roots == {w: "w19" for w, _ in chain[:-1]} | {"pair": "other"}


def test_edges(spark, edge_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert found(spelling.variants(edge_docs)) == by_hand(counted(docs))
    odd = ["Straße straße STRASSE ÀÉ×÷ÿÀÉ×÷ÿ àé×÷ÿàé×÷ÿ naïveté naïveté naïveté Ωmega", "a1b2c3d4 under_score x" + "y" * 40_000]
    docs = [(n % 40, t) for n in range(80) for t in odd]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(spelling.variants(frame)) == by_hand(counted(docs))


def test_empty_table(spark):
    assert found(spelling.variants(spark.createDataFrame([], "doc_id long, text string"))) == []


words = st.lists(st.text("abc", min_size=1, max_size=5), min_size=1, max_size=30, unique=True)


@given(words)
def test_acceptor_is_minimal_and_exact(some):
    made = spelling.Acceptor(sorted(some))
    rests = {}

    def accepted(state):
        if state not in rests:
            rests[state] = frozenset({""} if made.final[state] else ()) | {
                letter + rest for letter, then in made.edges[state].items() for rest in accepted(then)
            }
        return rests[state]

    assert accepted(made.start) == set(some)
    assert len(set(rests.values())) == len(rests)


@given(words)
def test_compositions_against_pairwise_edits(some):
    pairs = sorted(tuple(sorted(p)) for p in spelling.replaced(spelling.Acceptor(sorted(some))))
    assert pairs == sorted(tuple(sorted(p)) for p in combinations(some, 2) if len(p[0]) == len(p[1]) and one_edit(*p))
    every = spelling.Acceptor(sorted(some))
    assert sorted(spelling.inserted(every, every)) == sorted(
        (a, b) for a in some for b in some if len(b) == len(a) + 1 and one_edit(a, b)
    )
