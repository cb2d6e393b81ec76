"""Tokens, shards, archives and the mix: exact round trips and sums."""

import base64
import gzip
import hashlib
import io
import random
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from support import values
from tokenizers import Tokenizer

from churnkit.llm import bpe, curriculum, repair, warc

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SIGNS = "aeth in on\n  \t\r\x0b\x1c\x85\xa0ñé́日🙂'stxyzİſßΣ0123$%.,!<|endoftext|>"


@pytest.fixture(scope="module")
def coder():
    return bpe.coder_of(open(BYTE, encoding="utf-8").read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE)


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(SIGNS, max_size=60), st.text(st.characters(codec="utf-8"), max_size=40), st.lists(st.sampled_from(["<|endoftext|>", "don't", " the", "aaaaaaaa", "   ", "\n\n", "internationalization"]), max_size=8).map("".join)))
def test_byte_pairs_equal_the_library(coder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    ids = coder.encode(text)
    assert ids.tolist() == want
    assert coder.v.decode(ids).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_pieces_need_backtracking(coder, library):
    rng = random.Random(4)
    tokens = [t for t in coder.v.tokens if t.isalpha() and t.isascii()]
    for _ in range(3000):
        piece = b"".join(rng.choices(tokens, k=4)).decode()
        assert coder.v.encode_piece(piece) == library.encode(piece, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing(coder, library, texts, monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY", 5)
    for _, text, *_ in texts:
        assert coder.encode(text).tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_token_columns(docs, no_docs, texts, library):
    found = values(bpe.round_trip(docs, BYTE))
    want = []
    for doc_id, text, *_ in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(want, key=str)
    back = bpe.decode(bpe.encode(docs, BYTE), BYTE)
    assert values(back) == sorted(((i, t or "") for i, t, *_ in texts), key=str)
    assert bpe.round_trip(no_docs, BYTE).count() == 0


def test_ids_that_are_no_text(spark, library):
    ids = [int(np.flatnonzero([t == b"\xe6" for t in bpe.coder_of(open(BYTE, encoding="utf-8").read()).v.tokens])[0])]
    found = values(bpe.decode(spark.createDataFrame([(1, ids), (2, None), (3, [])], "doc_id long, ids array<int>"), BYTE))
    assert found == [(1, library.decode(ids)), (2, ""), (3, "")]


def test_shards_equal_the_library(docs, texts):
    tokenizer = Tokenizer.from_file(WORD)
    shards = repair.write_shards(docs, WORD, partitions=3)
    found = repair.read_shards(shards).orderBy("start").collect()
    ids = {(i, t): tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t, *_ in texts}
    want = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in found] == [r[0] for r in want]
    at = 0
    for r, (doc_id, text, *_) in zip(found, want):
        own = np.array(ids[doc_id, text], dtype="<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)


def test_no_shards(no_docs):
    assert repair.read_shards(repair.write_shards(no_docs, WORD)).count() == 0


@settings(max_examples=150, deadline=None)
@given(docs=st.lists(st.lists(st.sampled_from([2, 5, 7, 300, 49407]), min_size=0, max_size=200), min_size=1, max_size=8))
def test_grammar_round_trip_and_random_access(docs):
    docs = [[*d, 2] for d in docs]
    lengths = np.array([len(d) for d in docs])
    data = repair.pack(list(range(len(docs))), np.array([x for d in docs for x in d]), lengths)
    shard = repair.Shard(data)
    flat, sizes = shard.all()
    assert flat.tolist() == [x for d in docs for x in d] and (sizes == lengths).all()
    for k, d in enumerate(docs):
        assert shard.ids(k).tolist() == d
        a, b = len(d) // 3, len(d) - len(d) // 4
        assert shard.slice(k, a, b).tolist() == d[a:b]


def test_grammar_replaces_pairs():
    ids = np.array([1, 2, 3, 4] * 5000 + [9])
    data = repair.pack([1], ids, np.array([len(ids)]))
    assert len(data) < len(ids) / 10
    assert (repair.Shard(data).ids(0) == ids).all()


def test_grammar_goes_on_while_pairs_are_frequent():
    """A few copies in much other text, which save little a round, are folded as well."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 40_000, 32)
    ids = np.concatenate([x for _ in range(20) for x in (rng.integers(0, 40_000, 10_000), passage)])
    symbols, rules, _, base = repair.grammar(ids, np.arange(len(ids)) == len(ids) - 1)
    assert base + len(rules) < repair.SYMBOLS
    _, counts = np.unique(symbols[:-1].astype(np.int64) << 16 | symbols[1:], return_counts=True)
    assert counts.max() < repair.LEAST
    assert repair._expansions(rules, base).max() >= len(passage)


def test_symbols_go_to_the_most_frequent_pairs():
    """With more frequent pairs than symbols, a passage copied hundreds of times is folded whole before rarer pairs are."""
    rng = np.random.default_rng(2)
    passage = np.arange(40_000, 40_064)
    others = [np.repeat(rng.permutation(20_000)[None], 10, axis=0).reshape(10, -1) for _ in range(2)]
    ids = np.concatenate([np.tile(passage, 1) for _ in range(400)] + [x for o in others for x in o] + [[49_407]])
    last = np.zeros(len(ids), dtype=bool)
    last[np.arange(63, 400 * 64, 64)] = True
    last[-1] = True
    symbols, rules, ends, base = repair.grammar(ids, last)
    firsts = np.concatenate([[0], np.flatnonzero(ends) + 1])
    assert (np.diff(firsts)[:400] == 1).all()


def test_large_ids_raise():
    with pytest.raises(ValueError):
        repair.pack([1], np.array([70_000]), np.array([1]))


def test_a_round_counts_only_pairs_it_may_replace(monkeypatch):
    """The result is that of counting all of them."""
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 300_000) % 3_000).astype(np.int64)
    last = rng.random(len(ids)) < 0.01
    last[-1] = True
    counted, sizes = repair._counted, []
    monkeypatch.setattr(repair, "_counted", lambda keys: sizes.append(len(keys)) or counted(keys))
    found = repair.grammar(ids, last)
    few = sum(sizes)
    sizes.clear()
    monkeypatch.setattr(repair, "FEW", len(ids))
    whole = repair.grammar(ids, last)
    assert all(np.array_equal(a, b) for a, b in zip(found, whole))
    assert few < sum(sizes) / 2


def test_a_round_looks_at_what_it_replaces_and_makes(monkeypatch):
    """Not at all places left: what is counted and sorted in all rounds together stays within a few times the ids."""
    rng = np.random.default_rng(4)
    words = rng.integers(0, 200, (4_000, 6))
    ids = words[rng.zipf(1.2, 50_000) % len(words)].ravel()
    last = np.arange(len(ids)) % 500 == 499
    seen = []
    for name in ("bincount", "sort"):
        monkeypatch.setattr(np, name, lambda x, *args, own=getattr(np, name), **kwargs: seen.append(len(x)) or own(x, *args, **kwargs))
    symbols, rules, ends, base = repair.grammar(ids, last)
    assert len(rules) > 3 * repair.PER_ROUND
    assert sum(seen) < 8 * len(ids)
    _, counts = np.unique((symbols[:-1].astype(np.int64) << 16 | symbols[1:])[~ends[:-1]], return_counts=True)
    assert counts.max() < repair.LEAST


def test_short_batches_are_encoded_together():
    batches = [pa.record_batch({"doc_id": [i], "text": ["x" * 100]}) for i in range(7)]
    size = batches[0].nbytes
    joined = list(repair._together(iter(batches), 3 * size))
    assert [b.num_rows for b in joined] == [3, 3, 1]
    assert pa.Table.from_batches(joined) == pa.Table.from_batches(batches)
    assert [b.num_rows for b in repair._together(iter(batches), 1)] == [1] * 7


def test_the_cycle_collector_rests_while_shards_are_written():
    import gc

    assert gc.isenabled()
    with pytest.raises(ValueError), repair._no_cycles():
        assert not gc.isenabled()
        raise ValueError
    assert gc.isenabled()


_PIECES = ["don't,", "x<|endoftext|>.", "<|ENDOFTEXT|>", "É!!", "\u00e9\u0301,", "a's", "12.", "a\u0338=", "ſ,", "ª.", "×,", "Σ.", "ΑΣ", "İ", "ÀÖØÞßÿ", "e\u0301e", "", "\u2028"]


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def word_memory():
    return repair._Words(Tokenizer.from_file(WORD), 2)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(SIGNS + "ÉÇ÷×ßÞÿ=<|", max_size=40), st.lists(st.sampled_from(_PIECES), max_size=8).map(" ".join)), max_size=5))
def test_words_equal_the_library(word_library, word_memory, texts):
    ids, lengths = repair.encode_texts(pa.array(texts, pa.string()), word_memory)
    want = [word_library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and lengths.tolist() == [len(w) for w in want]


def test_words_are_learned_without_the_signs_behind_them(word_library):
    """And those of common letters are not put through the whole tokenizer."""
    words, asked = repair._Words(Tokenizer.from_file(WORD), 2), []
    words._each = lambda texts, each=words._each: asked.extend(texts) or each(texts)
    words._joined = lambda texts, joined=words._joined: asked.extend(texts) or joined(texts)
    text = "Été, été!! ÉTÉ. été*** und und, und!!"
    ids, _ = repair.encode_texts(pa.array([text]), words)
    assert ids.tolist() == [*word_library.encode(text, add_special_tokens=False).ids, 2]
    assert sorted(asked) == ["!!", "***", ",", "."]


def test_shards_are_cut_where_they_are_full(spark, monkeypatch):
    """A batch with the ids of many shards is dealt out to as many."""
    from types import SimpleNamespace

    import pyspark

    monkeypatch.setattr(repair, "store", lambda df, name: df)
    tasks, frame = [], type(spark.range(1))
    monkeypatch.setattr(frame, "mapInArrow", lambda self, run, schema: tasks.append(run) or spark.createDataFrame([], schema))
    monkeypatch.setattr(repair, "SHARD", 10)
    repair.write_shards(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), WORD)
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.record_batch({"doc_id": list(range(7)), "text": ["a b c"] * 7})
    shards = pa.Table.from_batches(list(tasks[0](iter([batch])))).to_pydict()
    assert shards["n_tokens"] == [12, 12, 4] and shards["number"] == [0, 1, 2]
    assert [repair.Shard(x).doc_ids for x in shards["shard"]] == [[0, 1, 2], [3, 4, 5], [6]]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>", i) for i in range(40)]
    rows += [(50, "http://h/é\r\nx", None, 1), (51, None, "", 2), (52, "u", "ü" * 200_000, 3), (None, "v", "<p>3</p>", 4), (None, "w", "alone", 5), (3, "http://h/3", "<p>3</p>", 6)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, refers_to long").repartition(3)


def test_archives_equal_the_pages(pages):
    found = warc.read_archives(warc.write_archives(pages)).collect()
    rows = pages.collect()
    first = {}
    for r in rows:
        if r["page_id"] is not None:
            body = r["html"] or ""
            first[body] = min(first.get(body, r["page_id"]), r["page_id"])
    want = []
    for r in rows:
        body = (r["html"] or "").encode()
        again = first.get(r["html"] or "")
        refers = None if again is None or again == r["page_id"] else again
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((r["page_id"], len(body), digest, "response" if refers is None else "revisit", refers))
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    for r in found:
        assert (hashlib.sha1(r["block"]).digest() == base64.b32decode(r["payload_digest"])) or r["record_type"] == "revisit" and r["block"] == b""


def test_small_payloads_are_never_revisited(pages):
    found = warc.read_archives(warc.write_archives(pages, least=100))
    assert found.filter("record_type = 'revisit'").count() == 0


def test_no_pages(pages):
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_archives_from_files(spark, pages, tmp_path):
    for r in warc.write_archives(pages).collect():
        (tmp_path / r["name"]).write_bytes(r["content"])
    assert warc.read_archives(warc.files(spark, str(tmp_path))).count() == pages.count()


def test_members_are_single_records_and_faults_raise():
    one = warc.record(1, "u", b"body", None, warc.digest(b"body"), 4)
    two = warc.record(2, "v", b"x" * 300_000, None, warc.digest(b"x" * 300_000), 300_000)
    assert gzip.decompress(one).endswith(b"body\r\n\r\n")
    assert [b for _, b in warc.records(io.BytesIO(one + two))] == [b"body", b"x" * 300_000]
    for broken in (
        warc.record(1, "u", b"body", None, warc.digest(b"other"), 4),
        one[:-9],
        gzip.compress(gzip.decompress(one).replace(b"Content-Length: 4", b"Content-Length: 3")),
        gzip.compress(gzip.decompress(one).replace(b"Content-Length: 4", b"Content-Length: 40")),
        gzip.compress(b"no record"),
    ):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.records(io.BytesIO(broken)))


def test_targets():
    assert curriculum.targets_of([100, 100, 100]) == [200, Fraction(500, 3), Fraction(250, 3)]
    assert curriculum.targets_of([]) == [] and curriculum.targets_of([0, 0]) == [0, 0]
    many = curriculum.targets_of([10, 2000, 30, 500, 1])
    assert sum(many) == Fraction(3, 2) * 2541
    assert all(t <= 2 * s for t, s in zip(many, [10, 2000, 30, 500, 1]))


def test_mix_takes_its_targets(docs, texts):
    rows = curriculum.taken(docs).toPandas()
    assert len(rows) == len(texts)
    by_source: dict = {}
    for _, text, _, source in texts:
        by_source[source] = by_source.get(source, 0) + len((text or "").encode().split())
    names = sorted((s for s in by_source if s is not None), key=str.encode) + [None]
    targets = curriculum.targets_of([by_source[s] for s in names])
    for name, target in zip(names, targets):
        own = rows[(rows["target"] == float(target)) & (rows["source_size"] == by_source[name])]
        assert own.taken.sum() == int(target)
    assert (rows.taken <= 2 * rows["size"]).all() and (rows.taken >= 0).all()
    again = curriculum.taken(docs.repartition(5)).toPandas()
    key = ["doc_id", "size", "taken", "target"]
    assert sorted(map(str, rows[key].itertuples(index=False))) == sorted(map(str, again[key].itertuples(index=False)))


def test_training_order_follows_the_weights(docs, no_docs):
    order = curriculum.schedule(docs).select("doc_id", "source", "mix_copy", "mix_taken", "mix_position", "component_id").toPandas()
    assert (order.mix_position.diff().dropna() >= 0).all()
    assert order.mix_position.between(0, 1).all()
    assert not order.duplicated(["doc_id", "source", "mix_copy", "mix_position"]).any()
    assert curriculum.schedule(no_docs).count() == 0 and curriculum.taken(no_docs).count() == 0


def test_taken_words_are_counted_in_the_training_order(spark, docs, no_docs):
    rows = curriculum.taken(docs)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    sort = plan.index("Sort [mix_position")
    assert "text#" in plan[sort:].split("\n")[1] and "Sort [mix_position" in plan  # the texts themselves are sorted
    found = sorted((r.doc_id or -1, r.size, r.taken, p) for r in rows.collect() for p in r.positions)
    order = curriculum.schedule(docs).collect()
    assert sorted((r.doc_id or -1, r.mix_size, p) for r in order for p in [r.mix_position]) == [(i, n, p) for i, n, _, p in found]
    for r in rows.collect():
        assert sorted(r.positions) == r.positions and bool(r.positions) == (r.taken > 0) and len(r.positions) <= curriculum.MOST
    empty = curriculum.taken(no_docs)
    assert empty.columns == ["doc_id", "size", "source_size", "target", "taken", "positions"] and empty.count() == 0


def test_rows_that_repeat_are_taken_one_by_one(spark):
    rows = [(1, "a b c", "s")] * 4 + [(None, "a b", "s")] * 2 + [(2, "", "s"), (2, None, "s"), (2, "", "s"), (7, "d e f g h", None)]
    found = curriculum.taken(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.doc_id or 0, r.size) for r in found) == sorted((i or 0, len((t or "").split())) for i, t, _ in rows)
    for source_size in {r.source_size for r in found}:
        own = [r for r in found if r.source_size == source_size]
        assert sum(r.taken for r in own) == int(own[0].target) and all(len(r.positions) == -(-r.taken // r.size) if r.size else not r.positions for r in own)


def test_positions_invert_the_demand(spark):
    rows = spark.range(101).select((F.col("id") / 100).alias("d"))
    for begin, end in curriculum.SLOPES:
        for r in rows.select("d", curriculum.position(F.col("d"), F.lit(begin), F.lit(end)).alias("t")).collect():
            demand = (begin * r["t"] + (end - begin) * r["t"] ** 2 / 2) / ((begin + end) / 2)
            assert abs(demand - r["d"]) < 1e-9


def test_a_task_gives_memory_back_and_keeps_words_for_its_own_operator_only():
    import pyarrow as pa
    from pyspark import cloudpickle

    from churnkit.llm import common

    made = []

    def run(batches):
        common.kept_by_worker("words", lambda: made.append(1) or {})
        return batches

    batch = pa.record_batch({"x": [1]})
    copies = [cloudpickle.loads(cloudpickle.dumps(common.tidy(lambda b: b, keeps=k))) for k in (True, False)]  # as tasks come to a worker
    common._KEPT.clear()
    for _ in range(2):
        assert list(common.tidy(run, keeps=True)(iter([batch]))) == [batch] and list(copies[0](iter([batch]))) == [batch]
    assert len(made) == 1 and list(common._KEPT) == ["words"]
    held = pa.default_memory_pool().bytes_allocated()
    assert list(copies[1](iter([batch]))) == [batch] and not common._KEPT
    assert common.tidy_group(lambda t: t.slice(0, 1))(pa.table({"x": [1, 2]})).num_rows == 1
    assert pa.default_memory_pool().bytes_allocated() <= held


def test_words_are_learned_once_a_worker_not_once_a_task(spark, monkeypatch):
    from types import SimpleNamespace

    import pyarrow as pa
    import pyspark
    from pyspark import broadcast, cloudpickle

    from churnkit.llm import common, repair

    tasks, made = [], []
    words = repair._Words

    class Counted(words):
        def __init__(self, *args):
            made.append(1)
            super().__init__(*args)

    frame = type(spark.range(1))
    monkeypatch.setattr(frame, "mapInArrow", lambda self, run, schema: tasks.append(run) or spark.createDataFrame([], schema))
    monkeypatch.setattr(repair, "store", lambda df, name: df)
    repair.write_shards(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), WORD)
    monkeypatch.setattr(repair, "_Words", Counted)
    monkeypatch.setattr(pyspark.TaskContext, "get", staticmethod(lambda: SimpleNamespace(partitionId=lambda: 0)))
    common._KEPT.clear()
    batch = pa.record_batch({"doc_id": [1], "text": ["a b"]})
    sent = cloudpickle.dumps(tasks[0])
    with open(WORD, encoding="utf-8") as file:
        monkeypatch.setattr(broadcast, "_broadcastRegistry", dict.fromkeys(range(10_000), SimpleNamespace(value=file.read())))
    shards = [list(cloudpickle.loads(sent)(iter([batch]))) for _ in range(3)]
    assert len(made) == 1 and shards[0] == shards[1] == shards[2] and shards[0][0].column("n_tokens").to_pylist() == [3]
    common._KEPT.clear()
