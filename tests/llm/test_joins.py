"""Near-duplicate joins against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F
from support import values

from churnkit.llm.common import components
from churnkit.llm.grid_join import near_duplicates
from churnkit.llm.ngram_join import distinct_documents, jaccard_components, linked_documents, occurrences, shingle_set


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def closure(names, links):
    up = {n: n for n in names}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in names}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 200 + i) for i in range(40)] + [(7, 7), (200, 100)]
    found = dict(values(components(spark.createDataFrame(edges, "a long, b long"))))
    want = {i: 1 for i in range(1, 31)} | {100: 100} | {200 + i: 100 for i in range(40)}
    assert {k: v for k, v in found.items() if k != 7} == {k: v for k, v in want.items() if k != 7}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_equals_all_pairs(docs, texts):
    rows = values(jaccard_components(docs))
    sets = {i: shingles(t) for i, t, *_ in texts if i is not None}
    links = []
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                links.append((a, b))
    want = closure(sets, links)
    assert len(rows) == len(texts)
    assert any(a != b for a, b in want.items())
    for doc_id, n, component in rows:
        if doc_id is None:
            assert component is None
        else:
            assert (n, component) == (len(sets[doc_id]), want[doc_id])


def test_jaccard_of_nothing(no_docs):
    assert jaccard_components(no_docs).count() == 0


def test_links_at_the_threshold(spark):
    words = [f"w{i}" for i in range(404)]
    # 400 shingles against 300 of them: exactly 75 %; and 299: just below.
    rows = [(1, " ".join(words)), (2, " ".join(words[:304])), (3, " ".join(["v", *words[:10], "u"])), (4, " ".join(f"z{i}" for i in range(404))), (5, " ".join(f"z{i}" for i in range(303)))]
    found = {r[0]: r[2] for r in values(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_common_passages_alone_link_nothing_and_large_groups_stay_whole(spark):
    """A passage in very many documents makes long lists; a large group of near copies is one component."""
    import random

    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(30))
    base = [f"b{i}" for i in range(200)]
    rows = [(i, " ".join(f"d{i}_{k}" for k in range(60)) + " " + passage) for i in range(150)]
    for i in range(1000, 1150):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(200)] = f"e{rng.random()}"
        rows.append((i, " ".join(copy)))
    found = {r[0]: r[2] for r in values(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))}
    sets = {i: shingles(t) for i, t in rows}
    near = [(a, b) for a in sets for b in sets if a < b and a >= 1000 and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = closure(sets, near)
    assert found == want


def test_rows_that_share_an_id_are_linked_each_by_its_own_text(spark):
    a, b = " ".join(f"a{i}" for i in range(100)), " ".join(f"b{i}" for i in range(100))
    rows = [(5, a), (5, b), (9, b + " end"), (7, a + " end"), (None, b + " other"), (None, "alone and without an id here"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = values(linked_documents(docs).select("doc_id", "component_id", "kept"))
    assert found == sorted([(5, 5, True), (5, 5, True), (9, 5, False), (7, 5, False), (None, 5, False), (None, None, True), (None, None, True)], key=str)
    kept = values(distinct_documents(docs.withColumn("kept", F.lit("x"))))
    assert kept == sorted([(5, a, "x"), (5, b, "x"), (None, rows[5][1], "x"), (None, "", "x")], key=str)


def test_a_list_with_many_components(spark):
    """Hundreds of documents share a passage just too short to link them; some pairs among them are near copies."""
    import random

    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(300):
        own = [f"w{i // 2}_{k}" for k in range(30)]
        if i % 2:
            own[rng.randrange(30)] = f"x{i}"
        rows.append((i, passage + " " + " ".join(own)))
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert 100 < len(links) < 200
    found = {r[0]: r[2] for r in values(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert found == closure(sets, links)


def test_counted_occurrences_equal_the_overlap():
    rng = np.random.default_rng(4)
    for _ in range(200):
        y = rng.choice(400, rng.integers(1, 120), replace=False).astype(np.uint64)
        others = [np.sort(rng.choice(np.concatenate([y, rng.choice(400, 60).astype(np.uint64)]), rng.integers(0, 90))) for _ in range(rng.integers(1, 9))]
        others = [np.unique(x) for x in others]
        extra = rng.integers(0, 9)
        sizes = np.array([len(x) + int(rng.integers(0, 5)) for x in others])
        got = occurrences(y, len(y) + extra, others, sizes, 75, 100)
        for keep, x, n in zip(got, others, sizes):
            both = len(set(x.tolist()) & set(y.tolist()))
            assert keep == (both >= math.ceil(75 * (n + len(y) + extra) / 175))


def test_shingles_count_words_apart_from_length():
    assert len(shingle_set("a b c d")) == 1 and len(shingle_set("a b c d e f")) == 2
    assert not len(shingle_set(None)) and not len(shingle_set(" \n"))
    assert (shingle_set("A b\tC d e") == shingle_set("a B c d E")).all()


def vectors_brute(rows):
    ok = {}
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = (label, np.array(v, dtype=float) / np.linalg.norm(v))
    links = [(a, b) for a in ok for b in ok if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= 0.98]
    counts = {i: 0 for i, *_ in rows}
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    return counts, closure(counts, links)


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    rows, centers = [], rng.normal(size=(6, 16))
    for i in range(240):
        v = centers[i % 6] + rng.normal(size=16) * (0.05 if i % 4 else 0.4)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2 if i % 31 else None))
    rows += [(300 + i, rows[5][1], rows[5][2]) for i in range(5)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [None] + [1.0] * 15, 1), (404, [float("inf")] + [1.0] * 15, 1), (405, [], 1), (406, [1.0, 2.0], 1), (407, [2.0, 4.0], 1)]
    return rows


def test_grid_join_equals_all_pairs(spark):
    rows = vectors()
    frame = spark.createDataFrame([(i, v, label, 7, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, id int, component string")
    counts, groups = vectors_brute(rows)
    assert sum(counts.values()) > 100
    found = values(near_duplicates(frame))
    assert len(found) == len(rows)
    for i, n, component, kept in found:
        assert (n, component, kept) == (counts[i], groups[i], groups[i] == i)


def test_grid_join_over_small_blocks(spark, monkeypatch):
    from churnkit.llm import grid_join

    monkeypatch.setattr(grid_join, "SMALL", 4)
    rows = [(i, v, 1) for i, v, _ in vectors(9) if v and len(v) == 16 and None not in v]
    counts, groups = vectors_brute(rows)
    found = values(near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")))
    assert {(i, n, c) for i, n, c, _ in found} == {(i, counts[i], groups[i]) for i, *_ in rows}


def test_no_vectors(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
