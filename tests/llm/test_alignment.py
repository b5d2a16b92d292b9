import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

import public_tokenizers
import sentencepiece
import tokenizers
from wayfare.llm import alignment
from wayfare.llm.queries import queries

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    return alignment.byte_level(PATHS[0]), alignment.pieces_of_words(PATHS[1])


def by_hand(docs):
    """The contract, with sets of ends and loops over pairs, from the two libraries."""
    first = tokenizers.Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    byte_of = alignment._byte_of_character()
    rows = []
    for doc_id, text in docs:
        groups = []
        if text:
            a = first.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in a.ids]
            b = [
                (i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode())
                for i in second.encode(text)
                for p in [second.id_to_piece(i)]
            ]
            raw = (" " + text).encode()
            if b"".join(x for _, x in a) == raw and b"".join(x for _, x in b) == raw:
                ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
                common = sorted(set(ends[0]) & set(ends[1]))
                places = [np.searchsorted(common, e) for e in ends]
                groups = [([], []) for _ in common]
                for side, tokens in enumerate((a, b)):
                    for place, (i, _) in zip(places[side].tolist(), tokens):
                        groups[place][side].append(i)
        rows.append((doc_id, groups))
    held = Counter()
    for _, groups in rows:
        held.update({(x, y) for a, b in groups for x in a for y in b})
    top = Counter()
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, groups in rows:
        links = [(x, y) for a, b in groups for x in a for y in b]
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc_id,
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            len(links),
            sum(held[x] == top[x[0]] for x in links),
            sum(held[x] for x in links),
            hashlib.sha256(line.encode()).hexdigest() if line else "",
        ))
    return out


def found(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return [tuple(r) for r in alignment.digests(frame, *PATHS).select(*COLUMNS).collect()]


def ordered(rows):
    return sorted(rows, key=str)


def test_query_against_the_definition(spark, sf_dir, tables):
    docs = [(r["doc_id"], r["text"]) for r in tables("documents").collect()]
    result = queries()["op13_token_alignment"](spark, sf_dir)
    assert ordered(tuple(r) for r in result.select(*COLUMNS).collect()) == ordered(by_hand(docs))


def test_edges_against_the_definition(spark, edge_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    strange = ["<s> </s> <unk> <0x41> <|endoftext|>", "▁a", "  x  ", "\x00", "é ﬁ ㍿", "\n\n\r\n\t ", "😀👩‍👩‍👧 漢字かな", "a" * 5_000, " " * 3_000]
    docs += [(100 + n, text) for n, text in enumerate(strange)]
    assert ordered(found(spark, docs)) == ordered(by_hand(docs))
    result = alignment.digests(edge_docs, *PATHS)  # with its clashing columns
    assert result.count() == edge_docs.count()


def test_empty_table(spark):
    assert found(spark, []) == []


def test_groups_are_the_tokens_cut_at_common_ends(spark, tables):
    docs = tables("documents").limit(50)
    for row in alignment.groups(docs, *PATHS, keep=("doc_id", "text")).collect():
        assert len(row["a_sizes"]) == len(row["b_sizes"])
        assert sum(row["a_sizes"]) == len(row["a_ids"]) and sum(row["b_sizes"]) == len(row["b_ids"])


@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.randoms())
def test_inner_ends_on_random_cuts(steps, rng):
    total = sum(steps)
    a = np.cumsum(steps).tolist()
    b = sorted({rng.randint(1, total) for _ in range(rng.randint(0, total))} | {total})
    in_a, in_b = alignment.inner_ends(a, b)
    common = set(a) & set(b)
    assert in_a == [i for i, x in enumerate(a) if x not in common]
    assert in_b == [i for i, x in enumerate(b) if x not in common]


def test_inner_ends_jumps_long_stretches():
    a = list(range(1, 10_001))
    b = [x for x in a if x not in (17, 5_000, 5_001, 9_999)]
    assert alignment.inner_ends(a, b) == ([16, 4_999, 5_000, 9_998], [])


def test_large_groups_are_folded_by_distinct_ids(tools, monkeypatch):
    rng = random.Random(5)
    batch = ["".join(rng.choice("aä漢😀 ") for _ in range(80)) for _ in range(20)]
    made = alignment.align(batch, *tools)
    whole = [x.tolist() for x in alignment.links(made)]
    monkeypatch.setattr(alignment, "LARGE_GROUP", 1)
    assert [x.tolist() for x in alignment.links(made)] == whole


def test_fast_ids_are_those_of_the_library(tools):
    first = tokenizers.Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    points = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000] + ["😀", "\U0010ffff"]
    batch = [f"a{c}b {c}1{c}!{c}{c} 's{c}" for c in points]
    assert tools[0].encode(batch) == [first.encode(" " + x, add_special_tokens=False).ids for x in batch]
