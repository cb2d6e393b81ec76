"""Token ids in shards under a Re-Pair grammar, with random access.

Documents are put in ascending doc_id order by range partitions, encoded with the tokenizers library (each distinct word of a
batch is looked up once; a memory per worker keeps the library off words it has seen), closed with an end id and gathered into
shards of ``SHARD`` ids, up to the end of the document in which they are reached. In each shard frequent pairs of neighbouring ids
are replaced by new symbols, again and again, until no pair is frequent enough or the symbols of 16 bits are used up; a round
replaces the most frequent pairs, down to half the count of the first of them, overlapping places from left to right, and counts
the pairs this makes, so pairs of new symbols have their turn before rarer ones. Pairs never cross the end of a document, so a document is a slice
of the symbol sequence.

A shard is one binary value (little-endian): magic, four counts (documents, rules, symbols, first nonterminal) as u64,
doc ids i64, null marks u8, first symbol of each document u64 (one more than documents), rules as pairs u16, the
expansion length of each rule u32, symbols u16. ``Shard.ids`` decodes one document, ``Shard.slice`` some ids of it, without the
rest. Shards are rows of a Parquet table in the shared folder (file = range partition, number in it), so any store that Spark
writes to will do. Two-byte symbols hold vocabularies of up to 65,535 ids; larger ones raise.

Null and empty texts are the end id alone; rows without an id come first; repeated rows are kept, in no particular order among
themselves. Other columns are ignored; an empty table gives no shards and an empty result.
"""

from __future__ import annotations

import gc
import os
import struct
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import WordTable, kept_by_worker, pieces, ragged, starts_of, store, tidy

END = 2
#: Ids of a shard, parts of words a worker remembers, bytes of text encoded at a time.
SHARD, MEMORY, BATCH_BYTES = 1_000_000, 1_200_000, 20_000_000
#: A pair is replaced if it stands at this many places at least; pairs of a round.
LEAST, PER_ROUND = 8, 1024
#: In shards of so few ids each round counts all pairs anew.
FEW = 40_000
SYMBOLS = 1 << 16
#: ASCII signs at the end of a word after a letter or digit, which the tokenizer parts from it.
_SIGNS = r"([0-9a-zÀ-ÖØ-öø-ÿ])([!-/:-@\[-`{-~]+)$"
#: Letters of which many words consist altogether; none is changed by those around it.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(c for c in map(chr, range(0xC0, 0x100)) if c.isalpha())
MAGIC = b"REPAIR01"
_HEAD = struct.Struct("<8s4Q")


def grammar(ids: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Symbols, rules (pairs), first-symbol marks of documents and the first nonterminal. ``last`` marks the end of each document.

    The sequence is a linked list over the places of the ids. A round looks at the places of the pairs it replaces, and counts the pairs that
    the new symbols make with their neighbours.
    """
    base = int(ids.max()) + 1 if len(ids) else 0
    if base >= SYMBOLS:
        raise ValueError(f"ids up to {base - 1} do not fit into two bytes")
    n = len(ids)
    # One place more on each side stands for what lies outside.
    symbols, last = np.append(ids, [0, 0]).astype(np.uint32), np.append(last, [True, True])
    after, before = np.arange(1, n + 3, dtype=np.int32), np.arange(-1, n + 1, dtype=np.int32)
    gone = np.zeros(n + 2, dtype=bool)
    known = _Pairs(n)
    known.add(_keys(symbols[:n], symbols[1 : n + 1], np.arange(n))[~last[:n]])
    rules = np.zeros((0, 2), dtype=np.int64)
    while base + len(rules) < SYMBOLS:
        pairs, places, chosen = known.most(min(PER_ROUND, SYMBOLS - base - len(rules)))
        # In a run of overlapping places every second one is taken.
        first = np.append([True], after[places[:-1]] != places[1:])[: len(places)]
        run = np.maximum.accumulate(np.where(first, np.arange(len(places)), 0))
        taken = (np.arange(len(places)) - run) % 2 == 0
        places, chosen = places[taken], chosen[taken]
        worth = np.bincount(chosen, minlength=len(pairs)) >= 2
        keep = worth[chosen]
        places, chosen = places[keep], chosen[keep]
        if not len(places):
            break
        names = (np.cumsum(worth) - 1 + base + len(rules)).astype(np.uint32)
        rules = np.concatenate([rules, np.stack([pairs >> np.uint64(16), pairs & np.uint64(0xFFFF)], axis=1)[worth].astype(np.int64)])
        right = after[places].astype(np.intp)
        beyond = after[right].astype(np.intp)
        symbols[places], last[places], gone[right] = names[chosen], last[right], True
        after[places], before[beyond] = beyond, places
        beside = before[places].astype(np.intp)  # -1, the last of the spare places, where nothing lies before
        changed = np.concatenate([places, beside[np.append([True], beside[1:] != places[:-1])]])
        known.drop(np.concatenate([changed, right]))
        if n <= FEW:
            known, changed = _Pairs(n), np.flatnonzero(~gone)
        changed = changed[~last[changed]]
        known.add(_keys(symbols[changed], symbols[after[changed]], changed))
    left = np.flatnonzero(~gone[:n])
    return symbols[left], rules, last[left], base


class _Pairs:
    """The pairs that stand at ``LEAST`` places at least, with their places.

    All places of a pair come up together, when the newer of its symbols does; from then on it can only become rarer. So a pair is counted
    once, places are taken off as they are lost, and a pair that is too rare at first is never looked at again.
    """

    def __init__(self, n: int):
        self.pairs, self.counts, self.starts, self.sizes = (np.zeros(0, dtype=kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
        self.number = np.full(n + 2, -1, dtype=np.int32)  # of the pair at each place
        # A replaced place is one less, and makes two pairs at most.
        self.places, self.used = np.empty(3 * n, dtype=np.int32), 0

    def add(self, keys: np.ndarray) -> None:
        """Pairs that stood nowhere before (upper half) with their places."""
        ranked, begins, counts = _counted(keys)
        often = np.flatnonzero(counts >= LEAST)
        begins, counts = begins[often], counts[often]
        places = (ranked[ragged(begins, counts)] & np.uint64(0xFFFFFFFF)).astype(np.int32)
        self.places[self.used : self.used + len(places)] = places
        self.number[places] = np.repeat(np.arange(len(self.pairs), len(self.pairs) + len(often), dtype=np.int32), counts)
        self.pairs = np.concatenate([self.pairs, ranked[begins] >> np.uint64(32)])
        self.counts, self.sizes = np.concatenate([self.counts, counts]), np.concatenate([self.sizes, counts])
        self.starts = np.concatenate([self.starts, self.used + starts_of(counts)])
        self.used += len(places)

    def drop(self, places: np.ndarray) -> None:
        """Places whose pair is no more."""
        numbers = self.number[places]
        self.counts -= np.bincount(numbers[numbers >= 0], minlength=len(self.counts))
        self.number[places] = -1

    def most(self, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The most frequent pairs, down to half the count of the first of them; all their places in order, and which of the pairs is there."""
        often = np.flatnonzero(self.counts >= max(LEAST, int(self.counts.max(initial=0)) // 2))
        top = often[np.lexsort((self.pairs[often], -self.counts[often]))[:limit]]
        places = self.places[ragged(self.starts[top], self.sizes[top])]
        stays = self.number[places] == np.repeat(top, self.sizes[top])
        both = np.sort((places.astype(np.uint64) << np.uint64(32) | np.repeat(np.arange(len(top), dtype=np.uint64), self.sizes[top]))[stays])
        return self.pairs[top], (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _keys(left: np.ndarray, right: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Pairs (upper half) with their places in one number each."""
    return left.astype(np.uint64) << np.uint64(48) | right.astype(np.uint64) << np.uint64(32) | places.astype(np.uint64)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (upper half) with their places in order, where each pair begins, and how often it stands there."""
    ranked = np.sort(keys)
    pairs = ranked >> np.uint64(32)
    begins = np.flatnonzero(np.append([True], pairs[1:] != pairs[:-1])[: len(pairs)])
    return ranked, begins, np.diff(np.append(begins, len(ranked)))


def pack(doc_ids: list[int | None], ids: np.ndarray, lengths: np.ndarray) -> bytes:
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum(lengths) - 1] = True
    symbols, rules, ends, base = grammar(ids, last)
    firsts = np.concatenate([[0], np.flatnonzero(ends) + 1]).astype("<u8")
    sizes = _expansions(rules, base)
    return b"".join(
        (
            _HEAD.pack(MAGIC, len(doc_ids), len(rules), len(symbols), base),
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            np.array([d is None for d in doc_ids], dtype=np.uint8).tobytes(),
            firsts.tobytes(),
            rules.astype("<u2").tobytes(),
            sizes[base:].astype("<u4").tobytes(),
            symbols.astype("<u2").tobytes(),
        )
    )


def _levels(rules: np.ndarray, base: int) -> Iterator[np.ndarray]:
    """Numbers of the rules, those first whose parts are ids, then those whose parts are known from the ones before."""
    known = np.arange(base + len(rules)) < base
    left = np.arange(len(rules))
    while len(left):
        ready = known[rules[left]].all(axis=1)
        if not ready.any():
            raise ValueError("rules that rest on themselves")
        yield left[ready]
        known[base + left[ready]] = True
        left = left[~ready]


def _expansions(rules: np.ndarray, base: int) -> np.ndarray:
    sizes = np.ones(base + len(rules), dtype=np.int64)
    for now in _levels(rules, base):
        sizes[base + now] = sizes[rules[now]].sum(axis=1)
    return sizes


class Shard:
    """A shard read from its bytes."""

    def __init__(self, data: bytes):
        magic, docs, rules, symbols, self.base = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no Re-Pair shard")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=count, offset=at)
            at += out.nbytes
            return out

        ids, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if n else int(i) for i, n in zip(ids, null)]
        self.firsts = take("<u8", docs + 1).astype(np.int64)
        self.rules = take("<u2", 2 * rules).reshape(-1, 2).astype(np.int64)
        self.sizes = np.concatenate([np.ones(self.base, dtype=np.int64), take("<u4", rules).astype(np.int64)])
        self.symbols = take("<u2", symbols)
        # What each symbol stands for, one after the other: a rule is its two parts, which stand before it.
        self.starts = starts_of(self.sizes)
        self.flat = np.zeros(int(self.sizes.sum()), dtype=np.int32)
        self.flat[: self.base] = np.arange(self.base)
        for now in _levels(self.rules, self.base):
            to = self.starts[self.base + now]
            for part in self.rules[now].T:
                size = self.sizes[part]
                self.flat[ragged(to, size)] = self.flat[ragged(self.starts[part], size)]
                to = to + size

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.starts[symbols], self.sizes[symbols])]

    def ids(self, doc: int) -> np.ndarray:
        return self._expand(self.symbols[self.firsts[doc] : self.firsts[doc + 1]])

    def slice(self, doc: int, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of a document, expanding only the symbols that hold them."""
        symbols = self.symbols[self.firsts[doc] : self.firsts[doc + 1]]
        ends = np.cumsum(self.sizes[symbols])
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        before = int(ends[first - 1]) if first else 0
        return self._expand(symbols[first : last + 1])[start - before : stop - before]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents and the length of each."""
        sizes = self.sizes[self.symbols]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self._expand(self.symbols), np.diff(ends[self.firsts])


class _Words(dict):
    """Numbers of parts of words in a table of their ids; the empty part has none.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its words, one by one.
    """

    def __init__(self, tokenizer, end: int):
        self.tokenizer, self.end = tokenizer, end
        suffix = tokenizer.model.end_of_word_suffix
        names = tokenizer.get_vocab(with_added_tokens=True)
        self.closing = np.zeros(max(names.values()) + 1, dtype=bool)
        self.closing[[i for name, i in names.items() if suffix and name.endswith(suffix)]] = True
        self.spelled = _spelling(tokenizer)
        self.plain = f"^[{_LETTERS}]+$" if self.spelled else r"[^\x00-\x{10FFFF}]"  # no word
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.table = WordTable()
        self[""] = self.table.add([])

    def learn(self, texts: list[str]) -> np.ndarray:
        """Numbers of new words. Words of common letters go to the library's model as they are spelled for it; words of other letters are encoded together and
        parted at the tokens that end a word, all others one by one."""
        is_plain = pc.match_substring_regex(pa.array(texts, pa.string()), self.plain).to_numpy(zero_copy_only=False)
        plain, rest = list(compress(texts, is_plain)), list(compress(texts, ~is_plain))
        numbers = np.empty(len(texts), dtype=np.int64)
        letters, other = [text for text in rest if text.isalpha()], [text for text in rest if not text.isalpha()]
        if plain:
            model = self.tokenizer.model.tokenize
            flat, sizes = [], []
            for text in plain:
                tokens = model(text if text.isascii() else text.translate(self.spelled))
                flat += [token.id for token in tokens]
                sizes.append(len(tokens))
            first = self.table.add_flat(flat, np.array(sizes))
            self.update(zip(plain, range(first, first + len(plain))))
            numbers[is_plain] = np.arange(first, first + len(plain))
        for at in range(0, len(letters), 4000):
            self._joined(letters[at : at + 4000])
        if other:
            self._each(other)
        numbers[~is_plain] = [self[text] for text in rest]
        return numbers

    def _each(self, texts: list[str]) -> None:
        first = self.table.add_all([one.ids for one in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
        self.update(zip(texts, range(first, first + len(texts))))

    def _joined(self, texts: list[str]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, dtype=np.int64)
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(texts):  # some letter is taken apart on the way
            self._each(texts)
            return
        first = self.table.add_flat(ids, np.diff(np.concatenate([[0], ends])))
        self.update(zip(texts, range(first, first + len(texts))))


def _spelling(tokenizer) -> dict[int, str] | None:
    """What the model is given for each of ``_LETTERS``; None if the tokenizer does more with a word than to spell its letters one by one."""
    change = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
    part = tokenizer.pre_tokenizer.pre_tokenize_str if tokenizer.pre_tokenizer else lambda text: [(text, None)]
    spelled = {ord(c): "".join(piece for piece, _ in part(change(c))) for c in _LETTERS}
    word = _LETTERS + _LETTERS[::-1]
    same = all(spelled[ord(c)] == c for c in _LETTERS if c.isascii())
    return spelled if same and [piece for piece, _ in part(change(word))] == [word.translate(spelled)] else None


def words_of_worker(vocabulary: str, end: int) -> _Words:
    """The words this worker has met, in all tasks so far."""

    def make() -> _Words:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return _Words(tokenizer, end)

    return kept_by_worker(("repair", hash(vocabulary), end), make)


def _parts(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.ListArray]:
    """How many words each text has, the number of each word, and the parts of each distinct word, in a form that has the same ids and comes again more often:
    A-Z in lower case, as the tokenizer puts them itself, and signs after a letter or digit as parts of their own, as it parts them.
    Special tokens are case-sensitive and stay whole."""
    special = pc.match_substring(texts, "<|")
    lower, whole = pc.ascii_lower(texts), pc.any(special).as_py()
    words = pc.ascii_split_whitespace(pc.if_else(special, texts, lower) if whole else lower)
    numbers = words.flatten().dictionary_encode()
    distinct = numbers.dictionary
    parted = pc.replace_substring_regex(distinct, _SIGNS, r"\1 \2")
    if whole:
        parted = pc.if_else(pc.match_substring(distinct, "<|"), distinct, parted)
    return pc.list_value_length(words), numbers.indices, pc.split_pattern(parted, " ")


def encode_texts(texts: pa.Array, words: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each closed by the end id, and the length of each. Every distinct word of them is looked up once."""
    if len(words) > MEMORY:
        words.forget()
    counts, places, parted = _parts(texts.fill_null(""))
    parts = parted.flatten().dictionary_encode()
    names = parts.dictionary.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist
    numbers = np.fromiter(map(words.get, names, repeat(-1)), dtype=np.int64, count=len(names))
    new = np.flatnonzero(numbers < 0).tolist()
    if new:
        numbers[new] = words.learn([names[i] for i in new])
    ids, sizes = words.table.gather(numbers[parts.indices.to_numpy()])
    # The ids of each distinct word, those of its parts one after the other; after the last of them the end id.
    upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(pc.list_value_length(parted).to_numpy())])]
    ids, starts, sizes = np.append(ids, words.end), upto, np.append(np.diff(upto), 1)
    end, counts, places = len(upto) - 1, counts.to_numpy(), places.to_numpy()
    order = np.full(len(places) + len(counts), end)
    order[np.arange(len(places)) + np.repeat(np.arange(len(counts)), counts)] = places
    lengths = sizes[order]
    return ids[ragged(starts[order], lengths)], np.diff(np.concatenate([[0], np.cumsum(lengths)[np.cumsum(counts + 1) - 1]]))


@contextmanager
def _no_cycles() -> Iterator[None]:
    """Without the collector of cycles: none are made here, and it would go through lists of all words again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def _together(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches in a row as one, up to so many bytes: the fewer batches, the fewer times a word is looked up."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > size:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def write_shards(docs: DataFrame, path: str | os.PathLike, end: int = END, partitions: int | None = None) -> DataFrame:
    """Shards of all documents in doc_id order: columns file, number, n_tokens, shard (binary); stored in the shared folder."""
    with open(path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    schema = pa.schema([("file", pa.int32()), ("number", pa.int32()), ("n_tokens", pa.int64()), ("shard", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with _no_cycles():
            yield from write(batches)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = words_of_worker(vocabulary.value, end)
        task, number = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            ids, lengths = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_pydict({"file": [task], "number": [number], "n_tokens": [len(ids)], "shard": [pack(names, ids, lengths)]}, schema=schema)

        for part in pieces(_together(batches, BATCH_BYTES), BATCH_BYTES):
            ids, lengths = encode_texts(part.column(1), words)
            ends, docs, at = np.cumsum(lengths), part.column(0).to_pylist(), 0
            while at < len(docs):
                before = int(ends[at - 1]) if at else 0
                upto = min(int(np.searchsorted(ends, before + SHARD - size)) + 1, len(docs))
                held.append((ids[before : ends[upto - 1]], lengths[at:upto]))
                names += docs[at:upto]
                size, at = size + len(held[-1][0]), upto
                if size >= SHARD:
                    yield shard()
                    names, held, size, number = [], [], 0, number + 1
        if held:
            yield shard()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = F.col("doc_id").asc_nulls_first()
    spread = texts.repartitionByRange(partitions, order) if partitions else texts.repartitionByRange(order)
    shards = spread.sortWithinPartitions(order).mapInArrow(tidy(run, keeps=True), "file int, number int, n_tokens long, shard binary")
    return store(shards, "repair_shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document, from the shards."""
    schema = pa.schema([("file", pa.int32()), ("number", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, number, data in zip(*(batch.column(n).to_pylist() for n in ("file", "number", "shard"))):
                shard = Shard(data)
                ids, lengths = shard.all()
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4").tobytes())
                starts = starts_of(lengths)
                sums = [zlib.crc32(raw[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), lengths.tolist())]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(shard.doc_ids, pa.int64()), pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64())],
                    schema=schema,
                )

    heads = shards.select("file", "number", "n_tokens")
    # One total per range partition: as many rows as partitions were written.
    totals = sorted((r["file"], r["n"]) for r in heads.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect())
    spark, rows, before = shards.sparkSession, [], 0
    for file, n in totals:
        rows.append((file, before))
        before += n
    files = spark.createDataFrame(rows, "file int, files_before long")
    inside = Window.partitionBy("file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = heads.withColumn("shards_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, "file")
    docs = shards.select("file", "number", "shard").mapInArrow(tidy(run), "file int, number int, doc_id long, before long, n_tokens long, ids_crc32 long")
    return docs.join(offsets.select("file", "number", (F.col("files_before") + F.col("shards_before")).alias("at")), ["file", "number"]).select(
        "doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
