"""Spelling variants: words of the corpus within one edit of each other, tied to their most frequent form.

The search is dynamic programming along a sorted word list. For a query x and a list word y only three cells of a row of the edit matrix can
be at most 1, those next to the diagonal. The row after the first d letters of y is the same for all words that share these letters, so it is
worked out once for the whole run of the list whose adjacent words share d letters or more (their LCP), and handed on to the shorter runs
inside it. A run whose three cells all exceed one edit is skipped as a whole. All queries of a list go down it together, one letter at a time,
as arrays of (query, run, row).

How it is laid out on Spark:

1. Words are counted in each task before they are shuffled; those with ``least_length`` letters and ``least_count`` occurrences are the vocabulary.
2. One edit leaves the letters before it and after it as they are. With s the length of the shorter word of a pair, either the first s // 2
   letters are shared or the last s - s // 2. So every word goes into lists by its first and by its last half, for s its own length and one
   less; lists by last halves hold the words backwards. A pair belongs to the first kind if it shares that much, else to the second: it is found once.
3. A list with more than ``LIST`` words, such as that of a very common beginning, is split the same way again: of the letters not known to be
   shared yet either the first half are shared or the rest. This goes on until lists are short or at most two letters differ freely, whose number
   the alphabet bounds. Nothing is cut off.
4. Lists are dealt by key, sorted, and worked through in stretches of bounded size.

Null and empty texts have no words. A run of letters in a row without an id is taken as it is. Repeated rows count again. Very long words and texts are
worked through whole. Only ``doc_id`` and ``text`` are read, whatever other columns are called. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import ragged, starts_of, store

#: Words of a list from which on it is split; words (and 16 letters each) held at a time; queries that go down their lists together.
LIST, STRETCH, TOGETHER = 20_000, 60_000, 8_192
#: Distinct words a task holds before it sends them on.
HELD = 200_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _occurrences(least_length: int, letter_drop: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=schema)
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                own: Counter[str] = Counter()
                for word, n in Counter(map(itemgetter(0), runs.finditer(text.as_py() or ""))).items():
                    own[word.lower() if word.isascii() else word.translate(_LOWER)] += n
                mark = zlib.crc32(f"{doc_id.as_py()}:".encode()) if doc_id.is_valid else None
                for word, n in own.items():
                    if mark is not None and letter_drop:
                        h = zlib.crc32(word.encode(), mark)
                        if h % letter_drop == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    held[word] += n
                if len(held) >= HELD:
                    yield sent()
        if held:
            yield sent()

    return run


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, letter_drop: int = 31) -> DataFrame:
    """word, n: the words of ``docs`` (doc_id, text) and their occurrences. One in ``letter_drop`` pairs of document and word loses
    a letter, chosen by checksum (0: none), so that there are misspellings to find."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sent = texts.mapInArrow(_occurrences(least_length, letter_drop), "word string, n long")
    return sent.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- one sorted list --------------------------------------------------------

def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)


def shared_starts(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Letters each word shares with the word before it; -1 for the first."""
    out = np.zeros(len(starts), dtype=np.int64)
    most = np.minimum(sizes[1:], sizes[:-1])
    alive = np.arange(1, len(starts))
    depth = 0
    while len(alive):
        alive = alive[most[alive - 1] > depth]
        alive = alive[flat[starts[alive] + depth] == flat[starts[alive - 1] + depth]]
        depth += 1
        out[alive] = depth
    out[:1] = -1
    return out


def near_in_lists(words: list[str], asked: np.ndarray, first: np.ndarray, upto: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (query, word) of all words one edit apart in sorted lists that stand one after the other.

    Query ``asked[i]`` searches the list ``first[i]`` .. ``upto[i]``, whose words share ``shared[i]`` letters with it and each other.
    """
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    flat, starts = np.append(_letters(words), np.uint32(0)), starts_of(sizes)
    lcp = shared_starts(flat, starts, sizes)
    by_depth = np.argsort(shared, kind="stable")
    entered, found_query, found_word = 0, [], []
    query = low = high = np.zeros(0, dtype=np.int64)
    row = np.zeros((3, 0), dtype=np.int8)
    depth = int(shared.min()) if len(shared) else 0
    while len(query) or entered < len(asked):
        if entered < len(asked):
            if not len(query):
                depth = int(shared[by_depth[entered]])
            upon = np.searchsorted(shared[by_depth], depth, side="right")
            new = by_depth[entered:upon]
            entered = upon
            query, low, high = (np.concatenate([x, y]) for x, y in ((query, asked[new]), (low, first[new]), (high, upto[new])))
            row = np.concatenate([row, np.array([[1 if depth else 2], [0], [1]], dtype=np.int8).repeat(len(new), axis=1)], axis=1)
        # The first word of a run may end here: the run shares ``depth`` letters, and shorter words come first.
        ends = sizes[low] == depth
        off = sizes[query] - depth + 1
        hit = ends & (off >= 0) & (off <= 2)
        hit[hit] = row[off[hit], np.flatnonzero(hit)] == 1
        found_query.append(query[hit])
        found_word.append(low[hit])
        low = low + ends
        open_ = low < high
        query, low, high, row = query[open_], low[open_], high[open_], row[:, open_]
        if not len(query):
            continue
        # Runs inside a run begin where the LCP is not above ``depth``.
        cuts = np.flatnonzero(lcp <= depth)
        left, right = np.searchsorted(cuts, low, side="right"), np.searchsorted(cuts, high, side="left")
        many = right - left + 1
        parent = np.repeat(np.arange(len(query)), many)
        inner = ragged(np.zeros(len(query), dtype=np.int64), many)
        at = left[parent] + inner
        cut = np.append(cuts, 0)
        begin = np.where(inner == 0, low[parent], cut[np.minimum(at - 1, len(cuts))])
        end = np.where(inner == many[parent] - 1, high[parent], cut[np.minimum(at, len(cuts))])
        query, old = query[parent], row[:, parent]
        letter = flat[starts[begin] + depth]
        size, start = sizes[query], starts[query]

        def differs(place):
            """0 where the query's letter at ``place`` is the run's, 1 where not, 2 outside the query."""
            inside = (place >= 0) & (place < size)
            return np.where(inside, flat[start + np.where(inside, place, 0)] != letter, 2).astype(np.int8)

        row = np.empty_like(old)
        row[0] = np.minimum(old[0] + differs(depth - 1), old[1] + 1)
        row[1] = np.minimum(np.minimum(old[1] + differs(depth), old[2] + 1), row[0] + 1)
        row[2] = np.minimum(old[2] + differs(depth + 1), row[1] + 1)
        # Cells beyond the query's end are no cells.
        row[1][size < depth + 1] = 2
        row[2][size < depth + 2] = 2
        np.minimum(row, 2, out=row)
        depth += 1
        alive = row.min(axis=0) <= 1
        query, low, high, row = query[alive], begin[alive], end[alive], row[:, alive]
    return np.concatenate([*found_query, np.zeros(0, np.int64)]), np.concatenate([*found_word, np.zeros(0, np.int64)])


def _same_start(a: str, b: str) -> int:
    at = 0
    for x, y in zip(a, b):
        if x != y:
            break
        at += 1
    return at


_PAIR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _pairs_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of whole lists, which stand one after the other, each sorted by its spelling."""
    keys = table.column("key").combine_chunks().dictionary_encode().indices.to_numpy()
    spelled = table.column("spelled").to_pylist()
    n, short, before, back, known = (table.column(c).to_numpy() for c in ("n", "short", "before", "back", "known"))
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    first, upto = np.repeat(edges[:-1], np.diff(edges)), np.repeat(edges[1:], np.diff(edges))
    for begin in range(0, len(spelled), TOGETHER):
        end = min(begin + TOGETHER, len(spelled))
        low, high = int(first[begin]), int(upto[end - 1])
        here = spelled[low:high]
        found = near_in_lists(here, np.arange(begin, end) - low, first[begin:end] - low, upto[begin:end] - low, known[begin:end].astype(np.int64))
        out: dict[str, list] = {name: [] for name in _PAIR.names}
        for i, j in zip(*(x.tolist() for x in found)):
            x, y, at = here[i], here[j], low + i
            if min(len(x), len(y)) != short[at]:
                continue
            if back[at]:
                x, y = x[::-1], y[::-1]
            if _same_start(x, y) < before[at]:
                out["word"].append(x)
                out["near"].append(y)
                out["near_n"].append(int(n[low + j]))
        yield pa.RecordBatch.from_pydict(out, schema=_PAIR)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the lists of this task, which come sorted by key and spelling, a stretch of whole lists at a time."""
    held, weight, limit = pa.table({}), 0, STRETCH
    for batch in batches:
        more = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, more]) if weight else more
        weight += batch.num_rows + batch.column("spelled").nbytes // 16
        if weight >= limit:
            keys = held.column("key")
            cut = pc.index(keys, keys[-1]).as_py()
            if cut:
                yield from _pairs_of(held.slice(0, cut))
            held = held.slice(cut)
            weight = held.num_rows + held.column("spelled").nbytes // 16
            limit = max(STRETCH, 2 * weight)
    if weight:
        yield from _pairs_of(held)


def _keyed(rows: DataFrame) -> DataFrame:
    """Lists are named by the length of the shorter word of a pair and by the letters known to be shared."""
    return rows.withColumn("key", F.concat_ws(" ", "short", F.expr("left(word, head)"), F.expr("right(word, tail)")))


def _lists(words: DataFrame) -> DataFrame:
    """Every word in its lists, with the long ones split; a stored table."""
    size = F.char_length("word")
    least = words.agg(F.min(size)).first()[0] or 0
    start = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short")).filter(F.col("short") >= least).select(
        "word", "n", "short", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(2**31 - 1).alias("before")
    )

    def halves(rows: DataFrame) -> DataFrame:
        middle = F.col("short") - F.col("head") - F.col("tail")
        half = F.floor(middle / 2).cast("int")
        firsts = F.struct((F.col("head") + half).alias("head"), F.col("tail"), F.col("before"))
        lasts = F.struct(F.col("head"), (F.col("tail") + middle - half).alias("tail"), (F.col("head") + half).alias("before"))
        return rows.select("word", "n", "short", F.explode(F.array(firsts, lasts)).alias("to")).select("word", "n", "short", "to.*")

    lists = store(_keyed(halves(start)), "spelling_lists")
    while True:
        open_ = F.col("short") - F.col("head") - F.col("tail") > 1
        long = store(lists.filter(open_).groupBy("key").count().filter(F.col("count") > LIST).select("key"), "spelling_long")
        if long.isEmpty():
            return lists
        lists = store(
            lists.join(long, "key", "left_anti").unionByName(_keyed(halves(lists.join(long, "key", "left_semi").drop("key")))), "spelling_lists"
        )


def near_pairs(words: DataFrame) -> DataFrame:
    """word, near, near_n for every ordered pair of words (word, n) exactly one edit apart; each pair once."""
    back = F.col("tail") > F.col("head")
    rows = _lists(words).select(
        "key", F.when(back, F.reverse("word")).otherwise(F.col("word")).alias("spelled"), "n", "short", "before", back.alias("back"),
        F.greatest("head", "tail").alias("known"),
    )
    return rows.repartition("key").sortWithinPartitions("key", "spelled").mapInArrow(_search, "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: forms followed to the last. Each step doubles the links followed; a form is ten times as frequent as its word, so
    chains are as long as the largest count has digits, at most."""
    roots = store(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = store(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling_roots")
        roots = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return roots


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a vocabulary (word, n)."""
    words = store(words, "spelling_words")
    pairs = near_pairs(words)
    best = pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    )
    found = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n"))
    enough = F.col("form_n") >= F.lit(ratio) * F.col("n")
    found = store(
        found.select("word", "n", "n_near", F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n")), "spelling_forms"
    )
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
