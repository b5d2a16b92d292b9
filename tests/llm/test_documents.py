import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import zstandard

from wayfare.llm import language, lines, mixing, perplexity, toxicity
from wayfare.llm.common import held_out


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_toxicity_on_held_out_rows(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    labels = {r["doc_id"]: r["toxic"] for r in marks.collect()}
    rows = toxicity.predictions(docs, marks).collect()
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(a == b for a, b in judged) >= 0.9 * len(judged)


def test_toxicity_features_match_brute_force():
    texts = ["Abcd abcd", "", "ab", "x" * 50, "Äbc"]
    docs, buckets = toxicity.features(texts, None)
    for n, text in enumerate(texts):
        low = text.lower()
        grams = {low[i : i + k] for k in toxicity.ORDERS for i in range(len(low) - k + 1)}
        assert (docs == n).sum() == len(grams)
    alone = [toxicity.features([t], None)[1].tolist() for t in texts]
    assert [buckets[docs == n].tolist() for n in range(len(texts))] == alone


def test_toxicity_fit_is_the_least_loss(monkeypatch):
    """Ratios counted one by one, and a gradient that vanishes at the weights found."""
    rng = np.random.default_rng(2)
    words = ["nice", "day", "tree", "river", "walk", "cloud", "vile", "scum"]
    batch, toxic = [], []
    for n in range(90):
        bad = n % 3 == 0
        chosen = rng.choice(words if bad or n % 10 == 1 else words[:6], int(rng.integers(3, 9)))
        batch.append(" ".join(chosen) + (" scum" if bad and n % 2 else ""))
        toxic.append(int(bad))
    toxic = np.array(toxic)
    found = toxicity.fit(batch, toxic, rounds=4_000)
    docs, buckets = toxicity.features(batch, None)
    held = {(d, b) for d, b in zip(docs.tolist(), buckets.tolist())}
    counts = {k: Counter(b for d, b in held if toxic[d] == k) for k in (0, 1)}
    ratio = {
        b: np.log((counts[1][b] + 1) / (toxic.sum() + 2)) - np.log((counts[0][b] + 1) / ((1 - toxic).sum() + 2))
        for b in {b for _, b in held}
    }
    used = {b for b, r in ratio.items() if abs(r) >= toxicity.LEAST_RATIO and counts[0][b] + counts[1][b] >= toxicity.LEAST_DOCS}
    assert used and set(np.flatnonzero(found.weights).tolist()) <= used
    score = np.full(len(batch), found.bias)
    for d, b in held:
        score[d] += found.weights[b] if b in used else 0.0
    share = np.where(toxic == 1, 0.5 / toxic.sum(), 0.5 / (1 - toxic).sum())
    error = (1 / (1 + np.exp(-score)) - toxic) * share
    slopes = [abs(error.sum())]
    for b in used:
        own = sum(error[d] for d, x in held if x == b)
        # In the scale of the fit: a feature's value is its ratio, its weight is divided by it.
        slopes.append(abs(own * ratio[b] + 1e-4 * found.weights[b] / ratio[b]))
    assert max(slopes) < 2e-3
    assert ((score > 0) == (toxic == 1)).mean() > 0.9


def test_toxicity_fit_holds_only_features_that_count():
    """Rare n-grams, nearly all there are, are not held for all texts at once."""
    rng = np.random.default_rng(4)
    letters = np.array([chr(0x4E00 + n) for n in range(8_000)])
    batch = ["".join(rng.choice(letters, 3_000)) + " scum" * (n % 2) for n in range(1_200)]
    toxic = np.array([n % 2 for n in range(1_200)], np.int64)
    tracemalloc.start()
    try:
        model = toxicity.fit(batch, toxic, rounds=5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.count_nonzero(model.weights) and peak < 120e6, peak


def test_toxicity_edge_rows(spark, edge_docs, no_labels):
    rows = toxicity.predictions(edge_docs, no_labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] < 0.01 for r in rows)
    labels = spark.createDataFrame([(1, 1, 1), (5, 1, 0), (None, 1, 1), (3, 1, None)], no_labels.schema)
    rows = toxicity.predictions(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.predictions(edge_docs.limit(0), no_labels).count() == 0


def counted(text):
    words = text.encode().split()
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 5))
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            duplicates += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(c in "#*$%&|<>" for c in text), duplicates, len(covered)


def test_line_counts_match_brute_force(edge_docs, tables, no_labels):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for docs in (edge_docs, tables("documents")):
        texts = Counter((r["doc_id"], *counted(r["text"] or "")) for r in docs.collect())
        found = lines.verdicts(docs, no_labels).collect()
        assert Counter((r["doc_id"], *(r[n] for n in names)) for r in found) == texts
        for r in found:
            failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
            assert r["base_failed"] == failed and r["kept"] == (not failed)
    assert lines.verdicts(edge_docs.limit(0), no_labels).count() == 0


def test_repeated_words_with_a_large_vocabulary():
    words = [f"w{i}".encode() for i in range(9000)]
    words = words + words[100:107] + [b"a"] * 4
    assert lines.repeated_words(words) == counted(b" ".join(words).decode())[4] == 14


def test_viterbi_matches_all_paths():
    rng = np.random.default_rng(1)
    field = lines.Field(rng.normal(size=(lines.FEATURES, 2)), rng.normal(size=(2, 2)))
    for length in (1, 2, 5):
        x = (rng.random((length, lines.FEATURES)) < 0.3).astype(float)
        scores = x @ field.emission

        def total(path):
            return scores[range(length), path].sum() + field.transition[path[:-1], path[1:]].sum()

        paths = [[(n >> i) & 1 for i in range(length)] for n in range(1 << length)]
        best = max(paths, key=total)
        assert field.viterbi(x).tolist() == best


def test_line_rules_on_held_out_rows(tables):
    quality = {r["doc_id"]: r["quality"] for r in tables("labels").collect()}
    rows = lines.verdicts(tables("documents"), tables("labels")).where("not base_failed").collect()
    judged = [(quality[r["doc_id"]], r["kept"]) for r in rows if quality.get(r["doc_id"]) is not None]
    judged_out = [x for x, r in zip(judged, rows)]
    assert sum(a == b for a, b in judged_out) >= 0.95 * len(judged_out)


def test_lines_of_mixed_documents(spark):
    """Lines of good documents with lines of symbols from bad ones among them: each is told."""
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    field = lines.learn(docs, marks)
    quality = {r["doc_id"]: r["quality"] for r in marks.collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = {label: [line for i, q in quality.items() if q == label and is_held_out(i) for line in texts[i].split("\n")] for label in (0, 1)}
    good = [x for x in out[1] if len(x.split()) >= 5]
    junk = [x for x in out[0] if len(x.split()) >= 5 and sum(c in "#*$%&|<>!" for c in x) >= 0.05 * len(x)]
    rng, right, total = np.random.default_rng(1), 0, 0
    for _ in range(300):
        some = [(x, 1) for x in rng.choice(good, 6)]
        at = int(rng.integers(0, 7))
        some[at:at] = [(x, 0) for x in rng.choice(junk, int(rng.integers(2, 5)))]
        _, rows, _ = lines.describe("\n".join(x for x, _ in some))
        found = field.viterbi(lines.line_features(rows))
        right += sum(a == b for a, (_, b) in zip(found, some))
        total += len(some)
    assert right >= 0.9 * total
    shares = [r["content_share"] for r in lines.judge(docs, field).where("NOT base_failed").collect()]
    assert sum(0 < x < 1 for x in shares) >= 0.02 * len(shares)  # labels do change inside documents


def test_line_labels_agree_with_the_document():
    field = lines.Field(np.zeros((lines.FEATURES, 2)), np.zeros((2, 2)))
    field.emission[0] = -1, 1
    field.emission[1] = 3, 0
    x = np.zeros((4, lines.FEATURES))
    x[:, 0], x[2:, 1] = 1, 1
    assert lines.line_labels(field, x, np.array([9, 9, 1, 1]), 1).tolist() == [1, 1, 0, 0]
    assert lines.line_labels(field, x, np.array([9, 9, 1, 1]), 0).tolist() == [0, 0, 0, 0]
    assert lines.line_labels(field, x, np.array([1, 1, 9, 9]), 0).tolist() == [1, 1, 0, 0]
    assert lines.line_labels(field, x, np.array([1, 1, 9, 9]), 1).tolist() == [1, 1, 1, 1]


def test_language_sizes_match_the_library(spark, tables):
    """Dictionaries, sizes and margins, made again row by row."""
    docs = [r for r in tables("documents").collect()]
    usable = {}
    for r in docs:
        if r["lang"] and r["text"] and not is_held_out(r["doc_id"]):
            usable.setdefault(r["lang"], []).append(r)
    hashes = {r["doc_id"]: r["h"] for r in tables("documents").selectExpr("doc_id", "xxhash64(doc_id) AS h").collect()}
    model = {}
    for lang in sorted(usable, key=lambda x: (-len(usable[x]), x)):
        pieces = []
        for r in sorted(usable[lang], key=lambda r: (hashes[r["doc_id"]], r["doc_id"]))[: language.SAMPLE_DOCS]:
            first = max(1, int((len(r["text"]) - language.SAMPLE_CHARS) / 2))
            pieces.append(r["text"][first - 1 : first - 1 + language.SAMPLE_CHARS].lower())
        model[lang] = "\n".join(pieces).encode()[-language.DICTIONARY_BYTES :]
    assert language.learn(tables("documents")) == model
    found = {r["doc_id"]: r for r in language.predictions(tables("documents")).collect()}
    for r in docs[:60]:
        raw = r["text"].lower().encode()
        cuts = [raw[i : i + language.BLOCK_BYTES] for i in range(0, len(raw), language.BLOCK_BYTES)]
        sizes = []
        for sample in model.values():
            data = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(
                level=language.LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
            )
            sizes.append(sum(len(coder.compress(x)) for x in cuts))
        best, second = sorted(sizes)[:2]
        own = found[r["doc_id"]]
        if any(map(str.isalpha, r["text"])):
            assert own["lang_pred"] == list(model)[sizes.index(best)]
            assert own["rejected"] == (1 - best / second < language.LEAST_MARGIN)
            assert own["score"] == pytest.approx(min(1, (1 - best / second) / language.SURE_MARGIN))


def test_language_samples_stay_bounded(spark, monkeypatch):
    """Rows that repeat an id give one piece, and rare languages beyond the bound none."""
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    rows = [(0, "aa", f"text {n % 3}") for n in range(50)] + [(n, "bb", f"other {n}") for n in range(40)] + [(2, "cc", "x")]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    assert list(model) == ["aa", "bb"] and model["aa"] == b"text 0"


def test_language_on_held_out_rows(tables):
    truth = {r["doc_id"]: r["lang"] for r in tables("documents").collect()}
    rows = language.predictions(tables("documents")).where("held_out").collect()
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.9 * len(rows)


def test_language_edge_rows(edge_docs, tables):
    model = language.learn(tables("documents"))
    rows = language.predict(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for row, text in zip(sorted(map(tuple, rows), key=repr), sorted(map(tuple, edge_docs.select("doc_id", "text").collect()), key=repr)):
        assert row[0] == text[0]
        assert (row[1] == "und") == (not any(map(str.isalpha, text[1] or "")))
    assert {r["lang_pred"] for r in language.predict(edge_docs, {}).collect()} == {"und"}
    assert language.predictions(edge_docs.limit(0)).count() == 0


def kneser_ney(texts, order):
    """Log probability of a text, straight from the definition."""
    pad = bytes([perplexity.START])
    grams = {order: Counter()}
    for t in texts:
        data = pad * (order - 1) + t + pad
        grams[order].update(data[i : i + order] for i in range(len(data) - order + 1))
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])
    cuts = {}
    for k, table in grams.items():
        n = [sum(v == i for v in table.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0
        d = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 2.0) if y else (0.5, 0.75, 0.9)
        cuts[k] = [0, *(min(max(a, low), high) for a, low, high in zip(d, (0.05, 0.1, 0.1), (1, 2, 3)))]

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / 256
        same = {g: c for g, c in grams[k].items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return p(gram[1:])
        cut = [cuts[k][min(c, 3)] for c in same.values()]
        c = same.get(gram, 0)
        return max(c - cuts[k][min(c, 3)], 0) / total + sum(cut) / total * p(gram[1:])

    def log_p(t):
        data = pad * (order - 1) + t + pad
        return sum(np.log(p(data[i : i + order])) for i in range(len(data) - order + 1))

    return log_p


def test_perplexity_matches_the_definition(spark):
    trusted = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "thé"]
    docs = trusted + ["the cow", "zzz", "", None, "x" * 300, "the cow"]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(docs)], "doc_id long, text string, lang string")
    for order in (1, 3, 4):
        model = perplexity.fit(frame.where("doc_id < 4"), order)
        truth = kneser_ney([t.encode() for t in trusted], order)
        for row in perplexity.scored(frame, model).collect():
            assert np.isclose(row["log_p"], truth((docs[row["doc_id"]] or "").encode()), rtol=1e-9)


def test_perplexity_on_labelled_rows(tables):
    quality = {r["doc_id"]: r["quality"] for r in tables("labels").collect()}
    rows = perplexity.judge(tables("documents"), tables("labels")).collect()
    kept = Counter((quality[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in quality)
    assert kept[1, True] >= 0.97 * (kept[1, True] + kept[1, False])
    assert kept[0, False] > kept[0, True]


def test_perplexity_finds_nine_of_ten(spark):
    """Where languages have enough trusted texts: what is rejected of each quality and kind."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    kept = {r["doc_id"]: r["kept"] for r in perplexity.judge(docs, labels).collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    found = Counter()
    for row in labels.where("quality IN (0, 1)").collect():
        words = texts[row["doc_id"]].split()
        repeated = row["quality"] == 0 and len(words) > 10 and len(set(words)) < 0.5 * len(words)
        found[row["quality"], repeated, kept[row["doc_id"]]] += 1
    assert found[1, False, False] <= 0.01 * found[1, False, True]
    bad = [found[0, r, k] for r in (False, True) for k in (False, True)]
    assert bad[0] + bad[2] >= 0.9 * sum(bad)
    assert bad[0] >= 0.95 * (bad[0] + bad[1]) and bad[2] >= 0.75 * (bad[2] + bad[3])


def test_long_texts_are_judged_more_closely(spark):
    """A text a little odd throughout passes while it is short; a good one at any length."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9)))) for _ in range(300)]

    def text(size, odd):
        picked = rng.choice(words, size)
        return " ".join("qx" + w if rng.random() < odd else w for w in picked)

    good = [(i, text(int(rng.integers(5, 200)), 0), "en") for i in range(900)]
    probes = [(1000, text(5, 0), "en"), (1001, text(30_000, 0), "en"), (1002, text(3_000, 0.5), "en"), (1003, "qx" + words[0], "en")]
    docs = spark.createDataFrame(good + probes, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], 1, 0) for r in good], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in perplexity.judge(docs, labels).collect()}
    assert [kept[i] for i in (1000, 1001, 1002)] == [True, True, False]
    assert sum(kept[r[0]] for r in good) >= 0.98 * len(good)


def test_perplexity_of_a_language_with_few_trusted_texts(spark):
    rng = np.random.default_rng(3)
    words = ["casa", "perro", "libro", "noche", "agua", "camino", "verde", "mesa", "calle", "tiempo"]
    more = ["haus", "hund", "buch", "nacht", "wasser", "weg", "tisch", "gasse", "zeit", "abend"]

    def rows(count, lang, own, first):
        return [(first + i, " ".join(rng.choice(own, int(rng.integers(3, 60)))), lang) for i in range(count)]

    spanish = rows(300, "es", words, 10_000)
    held = [r for r in spanish if is_held_out(r[0])]
    fitted = [r for r in spanish if not is_held_out(r[0])][:20]
    german = rows(600, "de", more, 0)
    names = "doc_id long, text string, lang string"
    docs = spark.createDataFrame(german + spanish, names)
    for few in (1, 2, 5):
        # The one that is most predictable, so that the others lie above it.
        model_rows = german + fitted + sorted(held, key=lambda r: -len(r[1]))[:few]
        labels = spark.createDataFrame([(r[0], 1, 0) for r in model_rows], "doc_id long, quality int, toxic int")
        kept = {r["doc_id"]: r["kept"] for r in perplexity.judge(docs, labels).collect()}
        assert sum(kept[r[0]] for r in spanish) >= 0.98 * len(spanish)


def test_perplexity_edge_rows(edge_docs, no_labels):
    rows = perplexity.judge(edge_docs, no_labels).collect()
    assert Counter((r["doc_id"], r["kept"]) for r in rows) == Counter(
        (r["doc_id"], bool(r["text"])) for r in edge_docs.collect()
    )
    assert perplexity.judge(edge_docs.limit(0), no_labels).count() == 0


def test_mixing_places_every_row_once(spark):
    sizes = {"a": 300, "b": 40, "c": 95, None: 7}
    rows = [(i, s, 0) for i, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, slot int")
    weights = {"a": 1.0, "b": 1.0, "c": 2.0, None: 0.5, "unused": 3.0}
    found = mixing.positions(docs, weights, block_docs=8).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(len(rows)))
    assert len({r["position"] for r in found}) == len(rows)
    by_slot = {r["slot"]: r["source"] for r in found}
    names = [None, "a", "b", "c"]
    steps = mixing.exact_schedule([-(-sizes[x] // 8) for x in names], [weights[x] for x in names])
    assert [by_slot[i] for i in range(len(by_slot))] == [names[x] for x, _ in steps]
    with pytest.raises(ValueError, match="no weight for"):
        mixing.positions(docs, {"a": 1.0, "b": 1.0, "c": 0.0, None: 0.5})


def test_any_number_of_sources(spark):
    docs = spark.range(5_002).selectExpr("id AS doc_id", "concat('s', id % 2501) AS source")
    found = mixing.positions(docs, block_docs=1).collect()
    assert sorted(r["position"] for r in found) == list(range(5_002))
    # All weights are equal: each source has one of the first slots.
    assert len({r["source"] for r in found if r["position"] < 2_501}) == 2_501


def test_rows_of_one_id_are_numbered_apart(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_OF_A_KEY", 16)
    monkeypatch.setattr(mixing, "NUMBERED_AT_ONCE", 50)
    docs = spark.range(2_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS doc_id",
        "concat('s', id % 2) AS source", "concat('t', id % 500) AS text")
    found = mixing.positions(docs, block_docs=4).collect()
    assert len({r["position"] for r in found}) == 2_000
    given = Counter((r["doc_id"], r["source"]) for r in docs.collect())
    assert Counter((r["doc_id"], r["source"]) for r in found) == given
    assert Counter(map(tuple, mixing.mixed(docs).collect())) == Counter(map(tuple, docs.collect()))
    numbered = mixing.numbered(docs.selectExpr("source AS __source", "doc_id AS __key"), 2_000)
    by_source = Counter()
    for r in numbered.collect():
        by_source[r["__source"], r["__n"]] += 1
    assert set(by_source.values()) == {1} and len(by_source) == 2_000


def fluid(blocks, weights, slots):
    """What each source should have placed after so many slots, by the given weights."""
    sent = {x: Fraction(0) for x in blocks}
    while slots > 0 and (open_ := [x for x in blocks if sent[x] < blocks[x]]):
        total = sum(Fraction(weights[x]) for x in open_)
        step = min([Fraction(slots)] + [(blocks[x] - sent[x]) * total / Fraction(weights[x]) for x in open_])
        for x in open_:
            sent[x] += step * Fraction(weights[x]) / total
        slots -= step
    return sent


def test_mixing_keeps_to_the_given_weights():
    third = [40_000] + [4_000] * 19
    for blocks, weights in (
        (third, [n**0.5 for n in third]),
        ([3, 0, 700, 90, 1], [1e-3, 5.0, 1 / 3, 0.1, 2.0]),
        ([2] * 1500 + [3000], [n**0.5 for n in [2] * 1500 + [3000]]),
    ):
        steps = list(mixing.exact_schedule(blocks, weights))
        assert Counter(x for x, _ in steps) == Counter({x: n for x, n in enumerate(blocks) if n})
        placed, looks = Counter(), {len(steps) * i // 20 for i in range(1, 21)}
        for t, (x, k) in enumerate(steps, 1):
            assert k == placed[x]
            placed[x] += 1
            if t in looks:
                target = fluid(dict(enumerate(blocks)), weights, t)
                assert all(abs(placed[x] - target[x]) < 1 for x in target)


def test_positions_keep_to_the_given_weights(spark):
    sizes = {"a": 3300, "b": 1700, None: 1600}
    weights = {"a": 0.50049, "b": 0.25, None: 0.24951}
    rows = [(i, s) for i, s in enumerate(x for x, n in sizes.items() for _ in range(n))]
    found = mixing.positions(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_docs=1)
    order = [r["source"] for r in found.orderBy("position").collect()]
    assert len(order) == len(rows)
    for t in range(200, len(order), 200):
        placed, target = Counter(order[:t]), fluid(sizes, weights, t)
        assert all(abs(placed[x] - target[x]) < 1 for x in sizes)


def test_mixed_rows(edge_docs, tables):
    for docs in (edge_docs, tables("documents"), edge_docs.limit(0)):
        mixed = mixing.mixed(docs)
        assert mixed.columns == docs.columns
        assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, docs.collect()))


def test_held_out(spark):
    frame = spark.range(200).selectExpr("id")
    assert all(r[1] == is_held_out(r[0]) for r in frame.select("id", held_out(frame["id"])).collect())
