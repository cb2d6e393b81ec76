"""Exact de-duplication, the mean-variance search and spelling variants against plain re-computations."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import values

from churnkit.llm import eenns, exact_dedup, spelling

# --- exact de-duplication ---------------------------------------------------


def test_decisions_on_every_odd_case(docs, texts):
    groups = defaultdict(list)
    for doc_id, text, *_ in texts:
        groups[text or ""].append(doc_id)
    rows = values(exact_dedup.decisions(docs))
    assert len(rows) == len(texts)
    kept = Counter()
    for doc_id, keep_id, size, stays, digest in rows:
        (text,) = [t for t in groups if hashlib.sha256(t.encode()).hexdigest() == digest]
        assert (size, keep_id) == (len(groups[text]), max((i for i in groups[text] if i is not None), default=None))
        assert not stays or doc_id == keep_id
        kept[digest] += stays
    assert len(kept) == len(groups) and set(kept.values()) == {1}


def test_normalised_texts_are_compared(docs, texts):
    rows = values(exact_dedup.decisions(docs, lambda text: F.upper(F.trim(text))))
    assert {r[0]: r[1] for r in rows}[3] == 79


def test_rows_that_stay_keep_their_columns(docs, texts):
    rows = values(exact_dedup.distinct_documents(docs))
    assert exact_dedup.distinct_documents(docs).columns == docs.columns
    assert sorted(r[1] or "" for r in rows) == sorted({t[1] or "" for t in texts})


def test_hot_texts_are_decided_without_a_shuffle(spark):
    rows = [(i, "common" if i % 3 == 0 else "second" if i % 7 == 0 else f"rare {i // 2}") for i in range(4000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    narrow = exact_dedup._narrow(table, exact_dedup.unchanged)
    found = {bytes(r["digest"]).hex(): (r["copies"], r["best"]["doc_id"]) for r in exact_dedup.frequent_winners(narrow).collect()}
    assert found[hashlib.sha256(b"common").hexdigest()] == (1334, 3999)
    count = Counter(t for _, t in rows)
    last = dict((t, i) for i, t in rows)
    for doc_id, keep_id, size, stays, _ in values(exact_dedup.decisions(table)):
        text = rows[doc_id][1]
        assert (keep_id, size, stays) == (last[text], count[text], doc_id == last[text])


def test_no_python_in_the_plan(docs):
    plan = exact_dedup.decisions(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_tables(spark, no_docs):
    assert exact_dedup.decisions(no_docs).count() == 0
    assert exact_dedup.distinct_documents(no_docs).count() == 0
    assert spelling.variants(spelling.vocabulary(no_docs)).count() == 0
    assert eenns.clusters(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# --- clustering -------------------------------------------------------------


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_the_nearest_and_passes_over_most(seed):
    rng = np.random.default_rng(seed)
    centroids = rng.integers(-100, 100, (40, 16)) + rng.integers(-400, 400, (40, 1))
    centroids[7] = centroids[3]
    points = np.concatenate([centroids[rng.integers(0, 40, 500)] + rng.integers(-9, 9, (500, 16)), centroids, np.zeros((1, 16), dtype=np.int64)])
    apart = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
    number, distance, worked = eenns.MeanOrder(centroids).nearest(points)
    assert (number == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    assert worked < apart.size / 4


def test_ties_in_mean_and_distance_go_to_the_smaller_number():
    centroids = np.array([[4, 0], [0, 4], [2, 2], [2, 2], [-9, 13]])
    points = np.array([[2, 2], [3, 1], [1, 3], [0, 0], [50, -50]])
    apart = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
    number, distance, _ = eenns.MeanOrder(centroids).nearest(points)
    assert number.tolist() == apart.argmin(axis=1).tolist() and distance.tolist() == apart.min(axis=1).tolist()


def plain_clusters(rows, dims, scale, k, rounds):
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), p) for i, p in kept if i is not None)[:k]
    centroids = [list(p) for _, p in starts]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centroids)) for _, p in kept]

    for _ in range(rounds):
        held = defaultdict(list)
        for (_, p), (_, n) in zip(kept, assign()):
            held[n].append(p)
        for n, ps in held.items():
            centroids[n] = [sum(column) // len(ps) for column in zip(*ps)]
    found = assign()
    inertia = Counter()
    for d, n in found:
        inertia[n] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, n, d, inertia[n], sum(inertia.values()), digest[n]) for (i, _), (d, n) in zip(kept, found)]


@pytest.mark.parametrize("count", [120, 3])
def test_clusters_equal_the_plain_ones(spark, count):
    rng = random.Random(count)
    rows = [(i, [rng.uniform(-2, 2) for _ in range(8)]) for i in range(count)]
    rows += [(1, rows[1][1]), (1, rows[1][1]), (None, rows[2][1]), (900, None), (901, [1.0] * 7), (902, [None] + [1.0] * 7)]
    rows += [(903, [float("nan")] + [1.0] * 7), (904, [float("-inf")] + [1.0] * 7), (905, []), (906, [0.0] * 8)]
    table = spark.createDataFrame([(i, e, "x", 1) for i, e in rows], "vec_id long, embedding array<double>, cluster string, distance int").repartition(3)
    got = values(eenns.clusters(table, dims=8, scale=64, k=5, rounds=3))
    assert got == sorted(plain_clusters(rows, 8, 64, 5, 3), key=str)


def test_components_too_large_for_exact_distances_raise(spark):
    table = spark.createDataFrame([(1, [1e9] * 8)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="scaled component"):
        eenns.clusters(table, dims=8)


# --- spelling variants ------------------------------------------------------


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :] or a[at + 1 :] == b[at:]


def plain_variants(words):
    found = {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        found[w] = (best if best and words[best] >= 10 * n else None, len(near))

    def root(w):
        return root(found[w][0]) if found[w][0] else w

    return sorted(((w, f, root(w), words[w], k, words[f] if f else None) for w, (f, k) in found.items()), key=str)


def plain_vocabulary(texts):
    words = Counter()
    for doc_id, text, *_ in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c < "\x7f" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{low}".encode())
                if h % 31 == 0:
                    low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 7:
                words[low] += 1
    return {w: n for w, n in words.items() if n >= 2}


def test_vocabulary_of_every_odd_case(spark, docs, texts):
    accents = [(500 + i, "ÉCOLES École ÀÉÎÕÜØß déjàvuu déjàvuu x" + "Mot" * (i % 4) + " " + "y" * 5000) for i in range(70)]
    more = spark.createDataFrame(accents, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    assert dict(values(spelling.vocabulary(more))) == plain_vocabulary(accents + texts)


def made_words(rng, letters, count):
    words = {}
    for _ in range(count):
        w = "".join(rng.choices(letters, k=rng.randint(3, 9)))
        words[w] = rng.choice([2, 3, 5, 40, 60, 900, 20_000])
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(w))
            words[rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])] = rng.randint(2, 9)
    return {w: n for w, n in words.items() if w}


@pytest.mark.parametrize("letters,count,longest", [("ab", 60, 20_000), ("abcé", 250, 20_000), ("abcé", 250, 12), ("ab", 60, 3), ("abcdefghijklmnoûpqr", 400, 20)])
def test_variants_equal_all_pairs(spark, monkeypatch, letters, count, longest):
    """Also with lists so short that they are split to the last."""
    monkeypatch.setattr(spelling, "LIST", longest)
    words = made_words(random.Random(count), letters, count)
    words |= {"a" * 400: 2, "a" * 401: 30, "a" * 200 + "b" + "a" * 200: 3, "con" + "b" * 30: 4, "b" * 33: 5}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert values(spelling.variants(table)) == plain_variants(words)


def test_stretches_and_slices_lose_no_pair(spark, monkeypatch):
    words = sorted(made_words(random.Random(9), "abcd", 300))
    rows = spelling._lists(spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    back = F.col("tail") > F.col("head")
    rows = rows.select("key", F.when(back, F.reverse("word")).otherwise(F.col("word")).alias("spelled"), "n", "short", "before", back.alias("back"), F.greatest("head", "tail").alias("known"))
    batches = rows.coalesce(1).sortWithinPartitions("key", "spelled").toArrow().to_batches(max_chunksize=37)
    want = sorted((x, y) for x in words for y in words if one_edit(x, y))
    for stretch, together in ((1, 5), (100, 64), (10_000, 10_000)):
        monkeypatch.setattr(spelling, "STRETCH", stretch)
        monkeypatch.setattr(spelling, "TOGETHER", together)
        got = [(r["word"], r["near"]) for b in spelling._search(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == want
