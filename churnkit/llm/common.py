"""Helpers the operators share: tables kept in the cluster's shared folder, word hashes, connected components."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Hashable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.session import ensure_checkpoint_dir

#: Characters that part words: space and 0x09-0x0D, which is what ``bytes.split`` takes as white space.
WORD = r"[^\x20\x09-\x0D]+"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


#: Bytes of rows that go to a Python worker at a time; by number of rows alone, long texts and sets would pile up.
ARROW_BYTES = 4 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """The session, with batches to Python workers bounded by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{folder}/{table}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage, and outlives any executor."""
    path = f"{ensure_checkpoint_dir(bounded(df.sparkSession))}/{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: What this worker keeps from task to task; nested functions reach it by ``kept_by_worker``, as they would travel with a copy of their own.
_KEPT: dict[Hashable, object] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def kept_by_worker(key: Hashable, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept for the tasks that follow in this worker until one comes that does not use it."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def _begin(keeps: bool) -> None:
    if not keeps:
        _KEPT.clear()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that gives freed memory back when it ends: workers outlive their stage, and what they hold is part of the executor's memory
    in the next one. With ``keeps`` what the worker keeps for this operator stays."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(keeps)
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidied


def tidy_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of one group."""

    def tidied(table: pa.Table) -> pa.Table:
        _begin(False)
        try:
            return run(table)
        finally:
            _give_back()

    return tidied


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(of)


def pieces(batches: Iterator[pa.RecordBatch], text_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``text_bytes`` at most (one row may be longer), so long texts cannot pile up."""
    for batch in batches:
        start, held = 0, 0
        sizes = np.zeros(batch.num_rows, dtype=np.int64)
        for column in batch.columns:
            if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
                sizes += np.asarray(pa.compute.binary_length(column).fill_null(0), dtype=np.int64)
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > text_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8; none for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that any bits of them may be used."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def starts_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths), dtype=np.int64)
    np.cumsum(lengths[:-1], out=out[1:])
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start+1, ... for each run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - starts_of(lengths), lengths)


def sampled(docs: DataFrame, marks: DataFrame, mark: str, sample: int) -> DataFrame:
    """turn, doc_id, text and mark of ``sample`` marked documents at most, those of the smallest id hashes.

    The ids are chosen first, from narrow rows; only then are texts read, of the chosen ones, whose list is broadcast at its
    bounded size.
    """
    turn = F.xxhash64("doc_id").alias("turn")
    chosen = docs.select("doc_id").join(marks.select("doc_id", mark), "doc_id").select(turn, "doc_id", mark).distinct()
    chosen = chosen.orderBy("turn", "doc_id").limit(sample)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("turn", "doc_id", "text", mark)


class WordTable:
    """Ids of words by number, in flat arrays; a word may carry a mark."""

    def __init__(self):
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 12, dtype=np.int64)
        self.sizes = np.zeros(1 << 12, dtype=np.int64)
        self.marks = np.zeros(1 << 12, dtype=bool)
        self.used = self.count = 0

    def add(self, ids: list[int], mark: bool = False) -> int:
        return self.add_all([ids], [mark])

    def add_all(self, words: list[list[int]], marks: list[bool] | None = None) -> int:
        """Number of the first word; the others follow."""
        return self.add_flat(list(chain.from_iterable(words)), np.array(list(map(len, words)), dtype=np.int64), marks)

    def add_flat(self, flat, sizes: np.ndarray, marks: list[bool] | None = None) -> int:
        """As ``add_all``, with the ids of all words one after the other."""
        first, end, upto = self.count, self.count + len(sizes), self.used + len(flat)
        while end > len(self.starts):
            self.starts, self.sizes, self.marks = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes, self.marks))
        while upto > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : upto] = flat
        self.sizes[first:end] = sizes
        self.starts[first:end] = self.used + starts_of(sizes)
        if marks:
            self.marks[first:end] = marks
        self.used, self.count = upto, end
        return first

    def ids(self, number: int) -> list[int]:
        return self.flat[self.starts[number] : self.starts[number] + self.sizes[number]].tolist()

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        sizes = self.sizes[numbers]
        return self.flat[ragged(self.starts[numbers], sizes)], sizes


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable, for every node of the edges (a, b): columns node, component.

    Alternates two steps on the edge table until it stays the same: every larger neighbour of a node is tied to the node's
    smallest neighbour, then every smaller one is. Only minima per node are gathered (combined before the shuffle), so a
    node with very many neighbours is no large group, and the number of rounds grows with the logarithm of the nodes.
    """

    def stamp(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    ties = store(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "ties"
    )
    before = stamp(ties)
    while before[0]:
        both = ties.union(ties.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = store(large, "ties")
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ties = store(small.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "ties")
        after = stamp(ties)
        if after == before:
            break
        before = after
    tied = ties.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tied.union(ties.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
