import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from wayfare.llm import bpe
from wayfare.llm.queries import ranks_path


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(ranks_path())


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def coder(ranks):
    return bpe.Codec(ranks)


def some_texts():
    rng = random.Random(3)
    letters = list("abrelvstmd''''  \n\t12é漢!?.&LR　\xa0\x1c\x85ⅷ😀́")
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 70))) for _ in range(3000)]
    return [*texts, "", "'ll'll've'd", "a" * 3000, "ab" * 2000, "<|endoftext|>", " " * 500, "x's'S"]


def test_cuts_are_those_of_the_pattern(coder):
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text in some_texts()[:1000]:
        points = np.append(np.frombuffer(text.encode("utf-32-le"), np.uint32), np.uint32(0x110000))
        assert np.flatnonzero(coder.splitter.starts(points)).tolist() == [
            m.start() for m in pattern.finditer(text)
        ]


def test_ids_and_round_trip(coder, ranks, reference):
    texts = some_texts()
    ids, counts, offsets = coder.encode(texts)
    decoder, end = bpe.Decoder(ranks), np.cumsum(counts)
    for text, first, last in zip(texts, end - counts, end):
        own = ids[first:last]
        assert own.tolist() == reference.encode_ordinary(text)
        assert decoder.decode(own).tobytes() == text.encode()
        assert offsets[first:last].tolist() == np.cumsum([0, *decoder.lengths[own]])[:-1].tolist()


def test_a_full_cache_changes_nothing(ranks, reference):
    small = bpe.Codec(ranks, cached=10)
    for text in some_texts()[:200]:
        assert small.encode([text])[0].tolist() == reference.encode_ordinary(text)


def test_edge_rows(edge_docs, reference):
    found = [tuple(r) for r in bpe.digests(edge_docs, ranks_path()).collect()]
    expected = []
    for row in edge_docs.collect():
        text = row["text"] or ""
        ids = reference.encode_ordinary(text)
        joined = ",".join(map(str, ids)).encode()
        sums = [hashlib.sha256(x).hexdigest() for x in (joined, text.encode())]
        expected.append((row["doc_id"], len(ids), *sums))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert bpe.digests(edge_docs.limit(0), ranks_path()).collect() == []
