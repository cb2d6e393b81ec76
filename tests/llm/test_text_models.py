"""Classifier, language model, rules and language ID: brute-force counts, held-out accuracy and odd inputs."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from support import values
from pyspark.sql import functions as F

from churnkit.llm import context_mix, langid, quality, rules
from churnkit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def labels(spark, texts):
    ids = [r[0] for r in texts if r[0] is not None]
    rows = [(i, i % 5 > 0, 0) for i in ids] + [(None, 1, 0), (999, 0, 1), (5, None, None)]
    return spark.createDataFrame([(i, None if q is None else int(q), t) for i, q, t in rows], "doc_id long, quality int, toxic int")


def test_classifier_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    model = quality.train(docs, labels.filter(~held))
    judged = quality.judge(docs.select("doc_id", "text"), model).join(labels.filter(held), "doc_id").toPandas()
    good = (judged.quality == 1) & (judged.toxic == 0)
    assert (judged.kept == good).mean() > 0.9
    assert judged.kept[good].mean() > 0.95
    assert judged.expected_grade.between(0, 2).all() and judged.tail_probability.between(0, 1).all()
    assert judged.expected_grade[good].mean() > judged.expected_grade[~good].mean() + 0.5


def test_thresholds_are_ordered_and_training_repeats():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, 8).astype(np.uint64)) for _ in range(400)]
    grades = np.array([int(s.min() > 3) + int(s.min() > 8) for s in sets])
    one, two = quality.fit(sets, grades), quality.fit(sets, grades)
    assert (np.diff(one.thresholds) > 0).all()
    assert (one.weights == two.weights).all()
    expected, tail = one.grades(one.scores(sets))
    assert np.corrcoef(expected, grades)[0, 1] > 0.7
    assert ((tail >= 0) & (tail <= 1)).all()


def test_classifier_odd_rows(docs, no_docs, labels, texts):
    model = quality.train(docs, labels)
    judged = quality.judge(docs, model)
    assert judged.count() == len(texts)
    assert {"id", "score", "mix_size"} <= set(judged.columns)
    assert judged.filter("kept is null or tail_probability is null").count() == 0
    assert quality.judge(no_docs, model).count() == 0
    empty = quality.train(no_docs, labels)
    assert quality.judge(docs, empty).filter("kept").count() == len(texts)


def brute_rules(text):
    ws = words(text)
    lines = [line for line in (text or "").split("\n") if words(line)]
    seen, windows, repeated = Counter(lines), Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2)), set()
    for i in range(len(ws) - 2):
        if windows[tuple(ws[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(ws) < 50 or 100 * len(repeated) > 50 * len(ws)
    return len(ws), sum(map(len, ws)), symbols, sum(seen.values()) - len(seen), len(repeated), failed


def test_statistics_equal_brute_force(docs, texts):
    judged = rules.judge(docs, []).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert len(judged) == len(texts)
    for r in judged:
        assert tuple(r)[2:8] == brute_rules(r["text"])
        assert r["kept"] == (not r["base_failed"])


def test_rules_query_on_held_out_labels(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    learned = rules.train(docs, labels.filter(~held))
    assert learned
    found = rules.judge(docs.select("doc_id", "text"), learned).join(labels.filter(held), "doc_id").filter("n_words >= 50").toPandas()
    bad = found.quality == 0
    assert (~found.kept[bad]).mean() > 0.85 and found.kept[~bad].mean() > 0.95


def test_first_rule_that_holds_is_named(spark):
    chain = [(rules.Condition("mean_word_chars", True, 6.0),), (rules.Condition("mean_word_chars", True, 3.0), rules.Condition("symbols_per_word", False, 0.5))]
    rows = [(1, "abcdefgh " * 3), (2, "abcd " * 3), (3, "a b"), (4, "ab## " * 3), (5, None)]
    judged = rules.judge(spark.createDataFrame(rows, "doc_id long, text string"), chain)
    assert dict(values(judged.select("doc_id", "rule"))) == {1: 1, 2: 2, 3: 0, 4: 0, 5: 0}


def test_no_rules_without_both_kinds_of_labels(docs, no_docs, labels):
    assert rules.train(docs, labels.filter("quality = 1")) == []
    assert rules.train(no_docs, labels) == []
    assert rules.judge(no_docs, []).count() == 0


@pytest.fixture(scope="module")
def lm(docs):
    return context_mix.scores(docs).toPandas()


def test_base_scores_equal_brute_force(lm, texts):
    fold = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    train = [t for i, t, *_ in texts if not fold(i)]
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for t in train for w in tokens(t))
    n, room = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    want = sorted((str(i), len(tokens(t)), sum(w in counts for w in tokens(t)), round(sum(math.log10((counts[w] + 0.1) / room) for w in tokens(t)), 6)) for i, t, *_ in texts)
    found = sorted((str(None if math.isnan(r.doc_id) else int(r.doc_id)), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in lm.itertuples())
    assert [w[:3] for w in want] == [f[:3] for f in found]
    assert np.allclose([w[3] for w in want], [f[3] for f in found], atol=1e-5)
    assert (lm.train_tokens == n).all() and (lm.score < 0).all()


def test_probabilities_of_the_next_sign_add_up_to_one(texts):
    """Over all 257 continuations of a text's beginning, what the model gives to each must sum to 1."""
    train = [(t or "").encode() for _, t, *_ in texts[:40]]
    code = context_mix.code_of(np.random.default_rng(3).integers(0, 50, 256 * 257))
    tables = [np.random.default_rng(k).integers(0, 9, 2 << bits).astype(np.float32) for k, (_, bits) in enumerate(context_mix.PREDICTORS)]
    model = context_mix.fitted(code, [t + 5000 for t in tables], train[:3])
    begin = train[0][:200] + train[0][:100]
    ended = model.log10([begin])[0]
    # A text that goes on has the same beginning; the decisions of the sign after it are cut out of each.
    slots, depths, sides, counts, said = context_mix.decisions(code, [begin + bytes([b]) for b in range(256)])
    _, mixed, cell, _ = model._mix(slots, depths, said)
    one = (1 / (1 + np.exp(-mixed)) + model.refined[cell]) / 2
    chance = np.log10(np.where(sides == 1, one, 1 - one))
    starts = np.concatenate([[0], np.cumsum(counts)])
    keys = [x * 257 + y for x, y in zip(b"\0" + begin, begin)]
    before = int(code.lengths[keys].sum())
    total = 10 ** (ended - chance[:before].sum())
    for b in range(256):
        own = chance[starts[b] : starts[b + 1]]
        total += 10 ** own[before : before + code.lengths[begin[-1] * 257 + b]].sum()
    assert abs(total - 1) < 1e-3


def test_scores_do_not_depend_on_the_batch(texts):
    raw = [(t or "").encode() for _, t, *_ in texts[:20]] + [b""]
    code = context_mix.code_of(np.ones(256 * 257, dtype=np.int64))
    odds = [np.random.default_rng(k).integers(-60, 60, 1 << bits).astype(np.int8) for k, (_, bits) in enumerate(context_mix.PREDICTORS)]
    model = context_mix.model_of(code, odds)
    together = model.log10(raw)
    assert np.allclose(together, [model.log10([t])[0] for t in raw], rtol=1e-6)


def test_lm_learns_more_than_word_counts(spark):
    found = QUERIES["op4_context_mixing"](spark, FOLDER).toPandas()
    held = found[found.held_out]
    assert held.score.sum() > held.base_score.sum()
    assert held.bits_per_byte.mean() < 3.5


def test_lm_of_nothing(no_docs, docs):
    assert context_mix.scores(no_docs).count() == 0
    held = docs.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0) & F.col("doc_id").isNotNull())
    untrained = context_mix.scores(held).toPandas()
    assert len(untrained) and (untrained.train_tokens == 0).all() and (untrained.n_known == 0).all()


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op10_nearest_centroid"](spark, FOLDER).join(docs, "doc_id").toPandas()
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95
    assert found.score.between(0, 1).all()


def test_language_of_odd_rows(docs, no_docs, texts):
    model = langid.train(docs.select("doc_id", "text", "lang"))
    found = values(langid.predict(docs, model))
    assert len(found) == len(texts)
    by_id = {r[0]: r for r in found}
    for doc_id in (80, 81, 82, 87):
        assert by_id[doc_id][1:3] == ("und", 0.0)
    assert {r[1] for r in found} <= {"en", "fr", "und"}
    assert langid.predict(no_docs, model).count() == 0
    nothing = langid.train(no_docs.select("doc_id", "text", "lang"))
    assert {r[1] for r in values(langid.predict(docs, nothing))} == {"und"}


def test_far_texts_are_rejected(spark):
    rows = [(i, "the cat and the dog " * 5, "en") for i in range(30)] + [(50 + i, "le chat et le chien " * 5, "fr") for i in range(30)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = spark.createDataFrame([(1, "the dog and the cat"), (2, "zzqx vvkj wwpq xkcd")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in langid.predict(tests, model).collect()}
    assert found[1]["lang_pred"] == "en" and found[2]["rejected"]
    assert found[2]["score"] < found[1]["score"]


def test_contexts_are_counted_whole_and_others_are_learned_from(spark):
    """Over several blocks and owners, each decision gets the counts of its whole context in all training texts; while learning, those of all others."""
    rows = [(i, f"{w} the {w}{i % 3} cat of {v} sat " * (1 + i % 4) + w * (4000 if i == 3 else 1)) for i, (w, v) in enumerate([("Über", "ox"), ("under", "Ox"), ("up", "fox")] * 9)]
    rows += [(None, "the cat"), (100, None), (101, "")]
    raw = [(t or "").encode() for _, t in rows]
    learn = [i is None or i % 4 > 0 for i, _ in rows]
    assert max(map(len, raw)) > 20_000  # long documents take part as well
    code = context_mix.code_of(np.random.default_rng(5).integers(0, 50, 256 * 257))
    docs = spark.createDataFrame([(i, t, ok) for (i, t), ok in zip(rows, learn)], "doc_id long, text string, learn boolean").repartition(3)

    def places(text, order):
        """(context, byte before, place in the code) and side of every decision."""
        padded = bytes(8) + text
        for at, sign in enumerate([*text, 256]):
            before = padded[: at + 8]
            context = before[-order:] if order else re.split(rb"[\x00\x20\x09-\x0D]", before.lower())[-1]
            key = before[-1] * 257 + sign
            for step in range(code.starts[key], code.starts[key] + code.lengths[key]):
                yield (context, before[-1], code.places[step]), code.sides[step]

    want = [Counter(x for t, ok in zip(raw, learn) if ok for x in places(t, order)) for order, _ in context_mix.PREDICTORS]
    shared, parts, seen = spark.sparkContext.broadcast(code), 3, 0
    stored = context_mix._blocks(docs, shared, parts).collect()
    assert len(stored) > 1
    for row in stored:
        block = context_mix._opened(code, parts, row["counts"], row["docs"], row["texts"])
        seen += len(block.texts)
        for _, texts, firsts in block.pieces():
            slots, *_ = context_mix.decisions(code, texts, firsts=firsts, ways=block.ways)
            for k, (order, _) in enumerate(context_mix.PREDICTORS):
                found = block.counts[k].reshape(-1, 2)[slots[k]]
                expected = np.array([[want[k][d, side] for side in (0, 1)] for t in texts for d, _ in places(t, order)])
                assert np.allclose(found, expected, rtol=1e-3)
        own = [t for t, ok in zip(block.texts, block.docs["learn"]) if ok and len(t) < 1000]
        small = block.docs["size"] < 1000
        block.docs = block.docs.copy()
        block.docs["learn"] &= small
        pieces = list(context_mix._others(block, code))
        for k, (order, _) in enumerate(context_mix.PREDICTORS):
            found = np.concatenate([p[0][k] for p in pieces]) if pieces else np.zeros(0)
            expected = []
            for t in own:
                mine = Counter(places(t, order))
                expected += [[want[k][d, side] - mine[d, side] for side in (0, 1)] for d, _ in places(t, order)]
            odds = context_mix.odds_of(np.array(expected, dtype=np.float32).ravel()) * context_mix._UNIT
            assert np.allclose(found, odds, atol=0.1)
    assert seen == len(rows)
    model = context_mix._learned(context_mix._blocks(docs, shared, parts), shared, parts)
    assert (model.weights != 0.4).any()


def test_places_in_the_ways_serve_as_slots():
    """Log-odds laid out along the ways are those of the slots; what is left of a text's own counts is that of a plain count."""
    rng = np.random.default_rng(6)
    texts = [bytes(rng.choice(list(b"ab c"), 300).tolist()) for _ in range(5)]
    code = context_mix.code_of(rng.integers(0, 50, 256 * 257))
    docs = np.array([(k, True, True, len(t)) for k, t in enumerate(texts)], dtype=context_mix._DOC)
    block = context_mix.Block(docs, texts, [], [], [])
    for order, _ in context_mix.PREDICTORS:
        found, index, _ = context_mix._distinct(context_mix._keys_of(texts, order), 2)
        lengths, _, way = context_mix._ways(code, found)
        block.firsts.append(context_mix.starts_of(lengths).astype(np.int32)[index])
        block.ways.append(way)
        block.counts.append(rng.integers(0, 60, 2 * (int(way.max()) + 1)).astype(np.float32))
    slots, *_ = context_mix.decisions(code, texts, firsts=block.firsts, ways=block.ways)
    places, *_ = context_mix.decisions(code, texts, firsts=block.firsts)
    assert len(places) == len(slots) and all((way[at] == slot).all() for at, slot, way in zip(places, slots, block.ways))
    (inputs, _, sides, _), = context_mix._others(block, code)
    ends = np.cumsum(context_mix.decisions(code, texts)[3])
    for own, slot, counts in zip(inputs, slots, block.counts):
        want = []
        for a, b in zip([0, *ends[:-1]], ends):
            mine = np.zeros_like(counts)
            np.add.at(mine, 2 * slot[a:b] + sides[a:b], 1)
            want.append(np.maximum(0, (counts - mine).reshape(-1, 2)[slot[a:b]]).ravel())
        assert (own == context_mix.odds_of(np.concatenate(want)) * context_mix._UNIT).all()


# --- models re-computed from what was fitted, row by row -------------------------


def test_grades_follow_from_features_and_thresholds(spark):
    """The classifier's query held against its own model: sum of weights, ordered thresholds, tail and expected grade."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    weight = dict(zip(model.known.tolist(), model.weights.tolist()))
    assert len(weight) > 20
    for r in quality.judge(docs.select("doc_id", "text"), model).collect():
        score = sum(weight.get(f, 0.0) for f in quality.features(r["text"]).tolist())
        upto = [1 / (1 + math.exp(max(-40, min(40, score - t)))) for t in model.thresholds]
        assert r["tail_probability"] == pytest.approx(1 - upto[-1], abs=1e-9)
        assert r["expected_grade"] == pytest.approx(sum(1 - p for p in upto), abs=1e-9)
        assert r["kept"] == (r["tail_probability"] >= quality.KEEP)


def test_verdicts_follow_from_the_rules(spark):
    """The decision list's query held against its rules, tried in order in Python on plainly counted statistics."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    learned = rules.train(docs, labels)
    assert learned
    seen = set()
    for r in rules.judge(docs.select("doc_id", "text"), learned).collect():
        value = {name: r[top] / r[bottom] if r[bottom] else 0.0 for name, (top, bottom) in rules.RATIOS.items()}
        first = 0
        for number, rule in enumerate(learned, 1):
            if all(value[c.name] >= c.threshold if c.above else value[c.name] < c.threshold for c in rule):
                first = number
                break
        failed = r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"]
        assert (r["rule"], r["base_failed"], r["kept"]) == (first, failed, not failed and not first)
        seen.add(first)
    assert len(seen) > 1


def test_languages_follow_from_all_centroids(spark):
    """Predictions held against the cosine with every centroid, worked out with dictionaries; frequencies over all training texts."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("doc_id % 3 = 0")
    model = langid.train(docs)
    texts = [r["text"] for r in docs.filter("lang is not null").collect() if r["text"] and any(c.isalpha() for c in r["text"])]
    held = Counter(int(g) for t in texts for g in langid.counts(t)[0])
    for place in range(langid.DIMENSIONS):
        assert model.idf[place] == pytest.approx(math.log((1 + len(texts)) / (1 + held[place])) + 1, rel=1e-5)
    for r in langid.predict(docs.select("doc_id", "text"), model).join(docs, "doc_id").collect():
        if r["lang_pred"] == langid.UNKNOWN:
            continue
        used, often = langid.counts(r["text"])
        vector = {int(g): math.log(1 + float(n)) * float(model.idf[g]) for g, n in zip(used, often)}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        cosines = [sum(v * float(c[g]) for g, v in vector.items()) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=cosines.__getitem__)
        assert r["score"] == pytest.approx(max(0.0, min(1.0, cosines[best])), abs=1e-5)
        near = {model.languages[model.owner[k]] for k, c in enumerate(cosines) if c > cosines[best] - 1e-5}
        assert r["lang_pred"] in near


def test_few_ids_are_enough_to_choose_the_sample():
    for each, rows in ((4, 10), (1500, 100_000), (1500, 10**9), (4, 0)):
        limit = langid._up_to(each, rows)
        expected = min(1.0, (limit + 2**63) / 2**64) * rows
        assert expected >= min(rows, each) and expected <= each + 10 * each**0.5 + 21
