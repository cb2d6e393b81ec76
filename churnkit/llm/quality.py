"""Quality classifier: ordinal regression with a cumulative logit link on graded ratings.

Grades rise from 0 (toxic) over 1 (poor) to 2 (good). One weight vector over hashed text features is shared by all grades, and ordered
thresholds turn its score s into P(grade <= k) = sigmoid(threshold_k - s). From that come the expected grade and the tail
probability P(grade = top), by which documents are selected.

Features are the 64-bit hashes of the distinct words of a text (A-Z in lower case), and binned shape ratios hashed the same way (share of
repeated words, of words with symbols, ...). Weights are learned by follow-the-regularised-leader steps with an L1 term, which
leaves a few thousand weights that are not 0; these are broadcast.

Learning looks at ``SAMPLE`` labelled rows at most (those of the smallest id hashes, whole texts); features that fewer than
``LEAST`` of them hold are left out, so the model is bounded by the sample, not by the table. All rows are scored, over whole texts.

Null and empty texts have no words, only shapes. Labels that are null or name no document are left out; with one
grade only (or none) the model is the prior of what was seen, and without labels everything is kept. Repeated rows are scored one by one; other
columns, whatever their names, are kept by ``judge`` unless they are named like its results; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import ragged, sampled, starts_of, tidy
from churnkit.llm.rules import statistics

SAMPLE, LEAST, GRADES = 12_000, 5, 3
#: Passes over the sample, rows of a step, and the learner's rate, smoothing and penalties.
PASSES, STEP, ALPHA, BETA, L1, L2 = 12, 128, 1.0, 1.0, 4.0, 0.1
#: Least tail probability of a document that is kept.
KEEP = 0.5
_FILTER_BITS = 22
RESULTS = ("expected_grade", "tail_probability", "kept")


def features(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit features of a text."""
    words = set(text.encode("utf-8", "surrogatepass").lower().split()) if text else set()
    n, chars, symbols, dup, repeat, lines, distinct, digits, same, top = statistics(text)
    shapes = {
        "length": np.log2(1 + n), "symbols": 8 * symbols / max(1, n), "dup": 8 * dup / max(1, lines), "repeat": 10 * repeat / max(1, n),
        "same": 10 * same / max(1, n), "top": 10 * top / max(1, n), "distinct": 10 * distinct / max(1, n), "digits": 20 * digits / max(1, chars),
        "chars": chars / max(1, n),
    }
    named = [f"\x00{k}{min(20, int(v))}".encode() for k, v in shapes.items()]
    hashes = map(xxhash.xxh3_64_intdigest, [*words, *named])
    return np.unique(np.fromiter(hashes, dtype=np.uint64, count=len(words) + len(named)))


@dataclass(frozen=True)
class Model:
    """Known features (sorted), their weights, and the ordered thresholds between the grades."""

    known: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        if not len(self.known) or not len(sets):
            return np.zeros(len(sets))
        flat = np.concatenate(sets)
        # Most words carry no weight: a bit table leaves the few that may.
        bits = np.uint64((1 << _FILTER_BITS) - 1)
        maybe = np.zeros(1 << _FILTER_BITS, dtype=bool)
        maybe[(self.known & bits).astype(np.int64)] = True
        places = np.flatnonzero(maybe[(flat & bits).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, flat[places]), len(self.known) - 1)
        value = np.where(self.known[at] == flat[places], self.weights[at], 0.0)
        rows = np.repeat(np.arange(len(sets)), sizes)[places]
        return np.bincount(rows, weights=value, minlength=len(sets))

    def grades(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the top grade."""
        upto = 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))
        return (1 - upto).sum(axis=1), 1 - upto[:, -1]


def fit(sets: list[np.ndarray], grades: np.ndarray) -> Model:
    """Weights and thresholds from feature sets and grades 0..GRADES-1; rows in a fixed order give the same model."""
    if not len(sets):
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, -20.0))
    shares = np.clip(np.cumsum(np.bincount(grades, minlength=GRADES))[:-1] / len(grades), 1e-6, 1 - 1e-6)
    thresholds = np.log(shares / (1 - shares))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets)
    known, index, counts = np.unique(flat, return_inverse=True, return_counts=True)
    often = counts >= LEAST
    number = np.cumsum(often) - 1
    keep = often[index]
    rows = np.repeat(np.arange(len(sets)), sizes)[keep]
    index = number[index[keep]]
    sizes = np.bincount(rows, minlength=len(sets))
    known, starts = known[often], starts_of(sizes)
    z, squares, weights = np.zeros(len(known)), np.zeros(len(known)), np.zeros(len(known))
    floor = np.full(GRADES - 1, 1.0)
    order = np.random.default_rng(7).permutation(len(sets))
    for turn in range(PASSES):
        for at in range(0, len(order), STEP):
            step = order[at : at + STEP]
            cols = index[ragged(starts[step], sizes[step])]
            owner = np.repeat(np.arange(len(step)), sizes[step])
            scores = np.bincount(owner, weights=weights[cols], minlength=len(step))
            upto = np.concatenate(
                [np.zeros((len(step), 1)), 1 / (1 + np.exp(np.clip(scores[:, None] - thresholds, -40, 40))), np.ones((len(step), 1))], axis=1
            )
            y = grades[step]
            here = np.arange(len(step))
            low, high = upto[here, y], upto[here, y + 1]
            chance = np.maximum(high - low, 1e-9)
            slopes = upto * (1 - upto)
            d_score = (slopes[here, y + 1] - slopes[here, y]) / chance
            d_thresholds = np.zeros(GRADES - 1)
            for k in range(GRADES - 1):
                d_thresholds[k] = (np.where(y == k + 1, slopes[:, k + 1] / chance, 0) - np.where(y == k, slopes[:, k + 1] / chance, 0)).sum()
            gradient = np.bincount(cols, weights=d_score[owner], minlength=len(known))
            touched = np.flatnonzero(gradient)
            g = gradient[touched]
            grown = squares[touched] + g * g
            sigma = (np.sqrt(grown) - np.sqrt(squares[touched])) / ALPHA
            z[touched] += g - sigma * weights[touched]
            squares[touched] = grown
            zs = z[touched]
            weights[touched] = np.where(
                np.abs(zs) <= L1, 0.0, -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(grown)) / ALPHA + L2)
            )
            floor += d_thresholds**2
            thresholds = np.maximum.accumulate(thresholds - ALPHA * d_thresholds / np.sqrt(floor))
            thresholds[1:] = np.maximum(thresholds[1:], thresholds[:-1] + 1e-3)
    used = weights != 0
    return Model(known[used], weights[used], thresholds)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from rated documents; a document rated more than once counts by its lowest ratings."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    rated = labels.filter("doc_id is not null").select("doc_id", grade.alias("grade")).filter("grade is not null")
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    schema = pa.schema([("turn", pa.int64()), ("doc_id", pa.int64()), ("grade", pa.int32()), ("features", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [features(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("turn"), batch.column("doc_id"), batch.column("grade"), pa.array(sets, pa.binary())], schema=schema)

    rows = sampled(docs, rated, "grade", sample).select("turn", F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("grade").cast("int").alias("grade"))
    found = rows.mapInArrow(tidy(run), "turn long, doc_id long, grade int, features binary").toPandas().sort_values(["turn", "doc_id", "features"], kind="stable")
    return fit([np.frombuffer(x, dtype=np.uint64) for x in found["features"]], found["grade"].to_numpy(dtype=np.int64))


def judge(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """All columns, expected_grade, tail_probability and kept of every row."""
    names = [c for c in docs.columns if c not in RESULTS]
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    at = names.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + ["expected_grade double, tail_probability double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                scores = shared.value.scores([features(t.as_py()) for t in part.column(at)])
                expected, tail = shared.value.grades(scores)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(expected), pa.array(tail)], names=[*names, *RESULTS[:2]])

    return kept.mapInArrow(tidy(run), schema).withColumn("kept", F.col("tail_probability") >= keep)
