"""N-gram Jaccard join by T-occurrence search over inverted lists.

A document is the set of its distinct five-word shingles (64-bit hashes). Two sets x and y reach the similarity t exactly when
they share at least T = ceil(t / (1 + t) * (|x| + |y|)) shingles, so y is a result for x when y stands on T of the inverted
lists of x's shingles. As in DivideSkip, the lists of a set are divided by length: the L longest are set aside, the others, the short ones, are merged
and the occurrences of y counted. Who stands on fewer than T - L short lists is out; the others are looked up in the L long lists by binary search.

How it is laid out on Spark:

1. One pass over the texts makes the sets and sends packed blocks of (shingle, place in block) to the owners of hash ranges.
   A shingle that one block holds ``HOT`` times is not sent by document: it is long whatever the others hold.
2. An owner counts the documents of each list and answers each block with its shingles on lists of two or more. A shingle on a
   list of one can't be shared. Documents with fewer than ceil(t * |x|) shared shingles have no partner and leave here.
   List lengths above ``HOT`` count as equal, ties go by hash: the order need only be the same for all documents.
3. Documents of equal sets are one class from here on, whatever their ids; classes have numbers of their own.
4. With all but T - 1 lists of a set merged a partner comes up at least once, so the shortest |x| - T + 1 lists are joined to find who can occur at all,
   in two steps that lose no link between components and never spell out all pairs of a
   group: first each member of a list against one leading member, the one with the fewest shingles of its own. What that links
   is tied to components. Then, on the lists that still hold several components, the members outside the list's largest one
   against all members of other components. Sizes and places bound the reachable overlap before a pair is made.
5. The sets that came up for one y are searched together: the short lists of y among them are merged and their occurrences counted, those below T - L
   leave, and for the rest the L long lists are probed.

Null and empty texts have no shingles, link with nothing and are their own component. Rows are returned one for one, so repeated rows stay
repeated; rows that share an id but not their text are linked each by its own text. A document without an id is linked like any other and takes the smallest id of its
component, null if that has none. Only ``doc_id`` and ``text`` are read: other columns,
whatever their names, are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import components, hashes_of, mixed, ragged, starts_of, store, tidy, tidy_group, words_of

WIDTH = 5
SIMILARITY = (75, 100)
#: Documents of a list from which on its length counts as long; lengths are kept in one byte.
HOT = 64
#: Shingles of a block of documents (each counts as 16 more, so places in a block fit two bytes), and shingles one owner counts at a time.
BLOCK, PART = 500_000, 500_000
#: Documents a block hands on at a time.
SLICE = 2_000

_FACTORS = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles; a text with fewer words is one shingle, one without words has none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = hashes_of(words)
    size = min(width, len(h))
    rolled = np.zeros(len(h) - size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for place in range(size):
            rolled = rolled * _FACTORS[0] + mixed(h[place : place + len(rolled)] + _FACTORS[1])
        return np.unique(mixed(rolled + np.uint64(size) * _FACTORS[2]))


_PACKED = ("shingles", "owners", "lengths", "ids", "marks", "sizes", "digests")
_ROUTED = "part long, block long, " + ", ".join(f"{n} binary" for n in _PACKED)


def _spread(parts: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        schema = pa.schema([("part", pa.int64()), ("block", pa.int64())] + [(n, pa.binary()) for n in _PACKED])

        def block(ids: list, marks: list, sets: list) -> pa.RecordBatch:
            nonlocal made
            number, made = (task << 32) + made, made + 1
            sizes = np.array([len(s) for s in sets], dtype=np.int32)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            # Equal sets of one block speak through the one with the smallest id.
            first: dict[bytes, int] = {}
            for i in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0)):
                if sizes[i]:
                    first.setdefault(digests[i], i)
            speakers = np.array(sorted(first.values()), dtype=np.int64)
            flat = np.concatenate([sets[i] for i in speakers]) if len(speakers) else np.zeros(0, np.uint64)
            owners = np.repeat(speakers.astype(np.uint16), sizes[speakers]) if len(speakers) else np.zeros(0, np.uint16)
            order = np.argsort(flat)
            flat, owners = flat[order], owners[order]
            starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
            runs = np.diff(np.append(starts, len(flat)))
            long = np.repeat(runs >= HOT, runs)
            rows: dict[str, list] = {n: [] for n in schema.names}

            def put(part, **values):
                rows["part"].append(part)
                rows["block"].append(number)
                for n in schema.names[2:]:
                    rows[n].append(values.get(n))

            table = np.array([-1 if x is None else 0 for x in ids], dtype=np.int8)
            put(
                number % parts, shingles=flat[long].tobytes(), owners=owners[long].tobytes(),
                lengths=np.full(int(long.sum()), HOT, np.uint8).tobytes(), sizes=sizes.tobytes(), digests=b"".join(digests),
                ids=np.array([x or 0 for x in ids], dtype=np.int64).tobytes() + table.tobytes(), marks=np.array(marks, dtype=np.int64).tobytes(),
            )
            short, shorter = flat[~long], owners[~long]
            known = flat[starts[runs >= HOT]]
            edges = np.searchsorted(_part_of(short, parts), np.arange(parts + 1))
            told = np.searchsorted(_part_of(known, parts), np.arange(parts + 1))
            for p in range(parts):
                if edges[p + 1] > edges[p] or told[p + 1] > told[p]:
                    put(p, shingles=short[edges[p] : edges[p + 1]].tobytes(), owners=shorter[edges[p] : edges[p + 1]].tobytes(), ids=known[told[p] : told[p + 1]].tobytes())
            return pa.RecordBatch.from_pydict(rows, schema=schema)

        ids, marks, sets, held = [], [], [], 0
        for batch in batches:
            for doc_id, text, mark in zip(batch.column(0), batch.column(1), batch.column(2)):
                one = shingle_set(text.as_py(), width)
                ids.append(doc_id.as_py())
                marks.append(mark.as_py())
                sets.append(one)
                held += len(one) + 16
                if held >= BLOCK:
                    yield block(ids, marks, sets)
                    ids, marks, sets, held = [], [], [], 0
        if ids:
            yield block(ids, marks, sets)

    return run


def _part_of(shingles: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the upper half of the hash: rising with the hash."""
    return ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _u64(buffer) -> np.ndarray:
    return np.frombuffer(buffer or b"", dtype=np.uint64)


def _u16(buffer) -> np.ndarray:
    return np.frombuffer(buffer or b"", dtype=np.uint16)


_ANSWER = pa.schema([("block", pa.int64())] + [(n, pa.binary()) for n in _PACKED])


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The packed numbers of a binary column, one row after the other, without a Python object a row."""
    buffers = [np.frombuffer(x.buffers()[2], dtype=np.uint8)[o[0] : o[-1]] for x in column.chunks if len(x) and x.buffers()[2] is not None for o in [_offsets(x)]]
    return np.concatenate(buffers).view(dtype) if buffers else np.zeros(0, dtype)


def _offsets(x: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_binary(x.type) else np.int32
    return np.frombuffer(x.buffers()[1], dtype=kind)[x.offset : x.offset + len(x) + 1]


def _count_lists(table: pa.Table) -> pa.Table:
    """The lists of one hash range: every block learns which of its shingles other documents hold, and how many do."""
    head = pc.is_valid(table.column("sizes"))
    own = table.filter(head).select(_ANSWER.names)
    sent = table.filter(pc.invert(head))
    flat = _joined(sent.column("shingles"), np.uint64)
    known = np.unique(_joined(sent.column("ids"), np.uint64))
    order = np.argsort(flat)
    ranked = flat[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(flat) else np.zeros(0, np.int64)
    runs = np.diff(np.append(starts, len(flat)))
    lengths = np.minimum(runs, HOT).astype(np.uint8)
    if len(known) and len(starts):
        lengths[np.isin(ranked[starts], known)] = HOT
    counted = np.empty(len(flat), dtype=np.uint8)
    counted[order] = np.repeat(lengths, runs)
    del order, ranked
    owners = _joined(sent.column("owners"), np.uint16)
    counts = pc.fill_null(pc.divide(pc.binary_length(sent.column("shingles")), 8), 0).to_numpy().astype(np.int64)
    blocks = sent.column("block").to_numpy()
    del sent
    keep = counted > 1
    out: dict[str, list] = {n: [] for n in ("block", "shingles", "owners", "lengths")}
    for number, start, many in zip(blocks.tolist(), starts_of(counts).tolist() if len(counts) else [], counts.tolist()):
        mine = slice(start, start + many)
        chosen = keep[mine]
        if chosen.any():
            out["block"].append(number)
            out["shingles"].append(flat[mine][chosen].tobytes())
            out["owners"].append(owners[mine][chosen].tobytes())
            out["lengths"].append(counted[mine][chosen].tobytes())
    told = {n: pa.array(out[n], _ANSWER.field(n).type) if n in out else pa.nulls(len(out["block"]), pa.binary()) for n in _ANSWER.names}
    return pa.concat_tables([own.cast(_ANSWER), pa.table(told, schema=_ANSWER)])


_DOCS = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("shared", pa.binary())])


def _close_block(least: tuple[int, int]):
    up, down = least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of a block with their shared shingles in list order, where enough of them are shared."""
        table = pa.Table.from_batches(batches)
        (head,) = table.filter(pc.is_valid(table.column("sizes"))).select(["ids", "marks", "sizes", "digests"]).to_pylist()
        sizes = np.frombuffer(head["sizes"], dtype=np.int32)
        n = len(sizes)
        ids = np.frombuffer(head["ids"][: 8 * n], dtype=np.int64)
        null = np.frombuffer(head["ids"][8 * n :], dtype=np.int8) < 0
        marks = np.frombuffer(head["marks"], dtype=np.int64)
        shingles = _joined(table.column("shingles"), np.uint64)
        owners = _joined(table.column("owners"), np.uint16)
        lengths = _joined(table.column("lengths"), np.uint8)
        del table
        order = np.lexsort((shingles, lengths, owners))
        del lengths
        shingles, shared = shingles[order], np.bincount(owners, minlength=n)
        del order, owners
        ends = np.cumsum(shared)
        for start in range(0, n, SLICE):
            rows = range(start, min(n, start + SLICE))
            many = sizes[start : start + SLICE].tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[start : start + SLICE], mask=null[start : start + SLICE]), pa.array(marks[start : start + SLICE]),
                    pa.array([head["digests"][16 * i : 16 * i + 16] if size else None for i, size in zip(rows, many)], pa.binary()),
                    pa.array(many, pa.int64()),
                    pa.array(
                        [
                            shingles[ends[i] - shared[i] : ends[i]].tobytes() if size and int(shared[i]) * down >= up * size else None
                            for i, size in zip(rows, many)
                        ],
                        pa.binary(),
                    ),
                ],
                schema=_DOCS,
            )

    return run


def _short_lists(up: int, down: int):
    schema = pa.schema([("shingle", pa.int64()), ("id", pa.int64()), ("n", pa.int32()), ("own", pa.int32()), ("place", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The shortest |x| - T + 1 lists of each set; shingles no one shares stand first and need no list."""
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                ids = np.asarray(part.column(0), dtype=np.int64)
                n = np.asarray(part.column(1), dtype=np.int64)
                lists = [_u64(x.as_py()) for x in part.column(2)]
                has = np.array([len(x) for x in lists], dtype=np.int64)
                own = n - has
                take = np.clip(n - -(-up * n // down) + 1 - own, 0, has)
                flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
                at = ragged(starts_of(has), take)
                inner = at - np.repeat(starts_of(has), take)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(flat[at].view(np.int64)), pa.array(np.repeat(ids, take)), pa.array(np.repeat(n, take).astype(np.int32)),
                        pa.array(np.repeat(own, take).astype(np.int32)), pa.array((inner + np.repeat(own, take)).astype(np.int32)),
                    ],
                    schema=schema,
                )

    return run


def lists_to_skip(needed: int, size: int) -> int:
    """How many of a set's longest lists are set aside: more where much overlap is needed, as probing one costs about the logarithm of its length."""
    return min(max(needed - 1, 0), size, int(needed / (0.1 * math.log2(HOT) + 1)))


def occurrences(y: np.ndarray, n_y: int, others: list[np.ndarray], sizes: np.ndarray, up: int, down: int) -> np.ndarray:
    """Which of the sets stand on enough of y's lists. ``y`` is in list order, shortest list first; the others are sorted by shingle.

    The search for one y: its short lists, restricted to the sets that came up, are merged and each set's occurrences counted; a set with
    fewer than T - L is out; the L long lists are probed for the rest.
    """
    needed = -(-up * (sizes + n_y) // (up + down))
    skipped = lists_to_skip(int(needed.min()), len(y))
    short, long = np.sort(y[: len(y) - skipped]), y[len(y) - skipped :]
    flat = np.concatenate(others)
    lengths = np.array([len(x) for x in others], dtype=np.int64)
    owner = np.repeat(np.arange(len(others)), lengths)
    at = np.searchsorted(short, flat)
    on_list = (at < len(short)) & (short[np.minimum(at, len(short) - 1)] == flat) if len(short) else np.zeros(len(flat), dtype=bool)
    counted = np.bincount(owner[on_list], minlength=len(others))
    for i in np.flatnonzero((counted >= needed - skipped) & (counted < needed)).tolist():
        probe = np.minimum(np.searchsorted(others[i], long), max(lengths[i] - 1, 0))
        counted[i] += int((others[i][probe] == long).sum()) if lengths[i] else 0
    return counted >= needed


#: Shingles of the sets searched for one y at a time.
SEARCHED = 2_000_000


def _search(up: int, down: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that reach the overlap. Rows of one b that stand together in a batch are searched together."""
        for batch in batches:
            b = batch.column("b").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else np.zeros(1, np.int64)
            keep = np.zeros(len(b), dtype=bool)
            sizes = batch.column("n_a").to_numpy().astype(np.int64)
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                y, n_y = _u64(batch.column("shared_b")[start].as_py()), batch.column("n_b")[start].as_py()
                at = start
                while at < end:
                    others: list[np.ndarray] = []
                    held, first = 0, at
                    while at < end and (held < SEARCHED or not others):
                        others.append(np.sort(_u64(batch.column("shared_a")[at].as_py())))
                        held += len(others[-1])
                        at += 1
                    keep[first:at] = occurrences(y, n_y, others, sizes[first:at], up, down)
            found = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([found.column("a"), found.column("b")], schema=schema)

    return run


def linked_documents(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """doc_id, mark (hash of the text), n_shingles, component_id and kept of every row of ``docs`` (doc_id, text).

    ``similarity`` is a fraction (up, down). ``kept`` holds for one document (id and mark) of each component, that with the smallest id, and for
    documents without words.
    """
    up, down = similarity
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(chars / 6 / PART))
    answers = texts.mapInArrow(tidy(_spread(parts, width)), _ROUTED).groupBy("part").applyInArrow(
        tidy_group(_count_lists), _ROUTED.removeprefix("part long, ")
    )
    closed = answers.groupBy("block").applyInArrow(tidy(_close_block(similarity)), "doc_id long, mark long, digest binary, n_shingles long, shared binary")
    members = store(closed.withColumn("row", F.monotonically_increasing_id()), "jaccard_members")
    # A class is named by the row of one member; another row speaks for it, as only one of each block carries the set.
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("best")
    classes = store(
        members.filter("digest is not null").groupBy("digest")
        .agg(F.min("row").alias("id"), F.count("*").alias("copies"), F.min(F.when(F.col("shared").isNotNull(), F.col("row"))).alias("row"), smallest),
        "jaccard_classes",
    )
    sets = store(
        members.filter("shared is not null").select("row", F.col("n_shingles").cast("int").alias("n"), "shared")
        .join(classes.filter("row is not null").select("id", "row"), "row").select("id", "n", "shared"),
        "jaccard_sets",
    )
    lists = store(sets.mapInArrow(tidy(_short_lists(up, down)), "shingle long, id long, n int, own int, place int"), "jaccard_lists")

    def reachable(x: str, y: str):
        """Overlap needed by the two sizes against what is left of both sets from this list on."""
        need = F.ceil(F.lit(up) * (F.col(f"{x}.n") + F.col(f"{y}.n")) / F.lit(up + down))
        return (F.col(f"{x}.n") - F.col(f"{x}.place") >= need) & (F.col(f"{y}.n") - F.col(f"{y}.place") >= need)

    def verified(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("shared_a"))
        b = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b"))
        return pairs.join(a, "a").join(b, "b").mapInArrow(tidy(_search(up, down)), "a long, b long")

    lead = lists.groupBy("shingle").agg(
        F.min(F.struct((F.col("own") / F.col("n")).alias("share"), "id", "n", "place")).alias("lead"), F.count("*").alias("long")
    )
    lead = store(lead.filter("long > 1").select("shingle", "lead.id", "lead.n", "lead.place"), "jaccard_leads")
    first = (
        lists.alias("x").join(lead.alias("y"), "shingle").filter(F.col("x.id") != F.col("y.id")).filter(reachable("x", "y"))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    )
    tied = store(components(verified(first)), "jaccard_tied")

    placed = lists.join(lead.select("shingle", F.col("id").alias("leader")), "shingle").join(
        tied.withColumnRenamed("node", "id"), "id", "left"
    )
    placed = placed.withColumn("component", F.coalesce("component", "id"))
    counted = placed.groupBy("shingle", "component").agg(F.count("*").alias("size"))
    mixed_lists = counted.groupBy("shingle").agg(F.max_by("component", "size").alias("main"), F.count("*").alias("kinds")).filter("kinds > 1")
    rest = store(placed.join(mixed_lists.select("shingle", "main"), "shingle").filter(F.col("id") != F.col("leader")), "jaccard_rest")
    second = (
        rest.filter("component <> main").alias("x").join(rest.alias("y"), "shingle")
        .filter((F.col("x.component") != F.col("y.component")) & reachable("x", "y"))
        .filter((F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    )
    ties = tied.select(F.col("node").alias("a"), F.col("component").alias("b")).union(verified(second))
    joined = store(components(ties), "jaccard_components")

    tied_classes = classes.join(joined.withColumnRenamed("node", "id"), "id", "left").filter("copies > 1 or component is not null")
    tied_classes = store(tied_classes.select("digest", F.coalesce("component", "id").alias("component"), "best"), "jaccard_tied_classes")
    first = tied_classes.groupBy("component").agg(F.min("best").alias("best"))
    named = store(tied_classes.select("digest", "component").join(first, "component").select("digest", "best"), "jaccard_named")
    chosen = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("mark") == F.col("best.mark"))
    return members.select("doc_id", "mark", "digest", "n_shingles").join(named, "digest", "left").select(
        "doc_id",
        "mark",
        "n_shingles",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("component_id"),
        (F.col("best").isNull() | chosen).alias("kept"),
    )


def jaccard_components(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text). ``similarity`` is a fraction (up, down)."""
    return linked_documents(docs, similarity, width).select("doc_id", "n_shingles", "component_id")


def distinct_documents(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns; of rows that repeat id and text one stays."""
    kept = linked_documents(docs, similarity, width).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("mark").alias("_mark")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_kept_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("_mark"))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
