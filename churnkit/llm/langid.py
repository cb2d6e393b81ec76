"""Language ID by nearest centroid over TF-IDF vectors of character n-grams.

A text is the hashed counts of its byte pairs and triples (letters in lower case, words set off by blanks, digits and signs left out), as
log(1 + count) * idf, scaled to length 1. Each language is described by several centroids, found by spherical k-means among its
training texts, and a text gets the language of the centroid with the largest cosine, which is also the score. A text is marked as
rejected when that cosine is lower than nearly all training texts of the language had to their own centroid.

Training reads text and language only. Document frequencies are counted over all training texts; the centroids are found on ``SAMPLE`` texts at
most, dealt evenly to the languages (those of the smallest id hashes, whole texts). The centroids are broadcast: languages x CENTROIDS x DIMENSIONS
numbers.

Null texts and texts without a letter are ``und`` with score 0, and so is everything when nothing could be learned. Ties go to the
language first in order of code point. Repeated rows are judged one by one; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE, CENTROIDS, ROUNDS = 6_000, 4, 12
DIMENSIONS = 4096
#: Share of a language's training texts that lie farther from their centroid than a text that is accepted.
REJECT = 0.002
UNKNOWN = "und"

#: Bytes that count: letters a-z and everything beyond ASCII; all others part words.
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text and how often each stands there."""
    raw = _FOLD[np.frombuffer((" " + (text or "").lower() + " ").encode("utf-8", "surrogatepass"), dtype=np.uint8)].astype(np.uint32)
    if len(raw) > 1:
        raw = raw[np.concatenate([[True], (raw[1:] != 32) | (raw[:-1] != 32)])]
    pairs = (raw[:-1] << np.uint32(8)) | raw[1:]
    triples = (pairs[:-1] << np.uint32(8)) | raw[2:]
    grams = np.concatenate([pairs * np.uint32(0x9E3779B1), (triples + np.uint32(1 << 24)) * np.uint32(0x85EBCA6B)])
    found = np.bincount((grams >> np.uint32(20)).astype(np.int64), minlength=DIMENSIONS)
    used = np.flatnonzero(found)
    return used.astype(np.uint16), found[used].astype(np.float32)


def vectors(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    """One row of length 1 per text (0 where a text has no n-gram)."""
    out = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
    for i, (used, often) in enumerate(rows):
        value = np.log1p(often) * idf[used]
        norm = float(np.sqrt(value @ value))
        if norm:
            out[i, used] = value / norm
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray

    def predict(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is too far from the language to be believed."""
        if not self.languages:
            return [UNKNOWN] * len(rows), np.zeros(len(rows)), np.ones(len(rows), dtype=bool)
        cosines = vectors(rows, self.idf) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        score = np.clip(cosines[np.arange(len(rows)), best].astype(float), 0.0, 1.0)
        language = self.owner[best]
        return [self.languages[k] for k in language], score, score < self.least[language]


def _cluster(points: np.ndarray, count: int) -> np.ndarray:
    """Spherical k-means, started from points far apart."""
    first = points.mean(axis=0)
    centers = [points[int(np.argmax(points @ first))]]
    nearest = points @ centers[0]
    while len(centers) < min(count, len(points)):
        centers.append(points[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, points @ centers[-1])
    centers = np.stack(centers)
    for _ in range(ROUNDS):
        own = np.argmax(points @ centers.T, axis=1)
        for k in range(len(centers)):
            total = points[own == k].sum(axis=0) if (own == k).any() else centers[k]
            norm = np.linalg.norm(total)
            centers[k] = total / norm if norm else total
    return centers


def fit(rows: list[tuple[np.ndarray, np.ndarray]], languages: list[str], seen: np.ndarray, texts: int) -> Model:
    """Model from a sample of texts, and from how many of all ``texts`` hold each n-gram."""
    idf = (np.log((1 + texts) / (1 + seen)) + 1).astype(np.float32)
    names = sorted(set(languages), key=str.encode)
    marks = np.array(languages, dtype=object)
    centroids, owner, least = [], [], []
    for k, name in enumerate(names):
        points = vectors([rows[i] for i in np.flatnonzero(marks == name)], idf)
        own = _cluster(points, CENTROIDS)
        centroids.append(own)
        owner += [k] * len(own)
        least.append(float(np.quantile((points @ own.T).max(axis=1), REJECT)))
    return Model(names, idf, np.concatenate(centroids) if names else np.zeros((0, DIMENSIONS), np.float32), np.array(owner, dtype=np.int64), np.array(least))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many of the texts hold each n-gram, and how many texts there are. A task sends one row per n-gram."""
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last place counts the texts.
        seen = np.zeros(DIMENSIONS + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen[counts(text.as_py())[0]] += 1
                seen[-1] += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(seen[used])], schema=schema)

    out = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in texts.select("text").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[r["place"]] = r["n"]
    return out[:-1], int(out[-1])


def _up_to(each: int, rows: int) -> int:
    """The hash below which ``each`` of ``rows`` ids lie for sure, and not many more: ten standard deviations above the mean."""
    share = min(1.0, (each + 10 * each**0.5 + 20) / max(1, rows))
    return min(2**63 - 1, int(share * 2**64) - 2**63)


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from (doc_id, text, lang) rows with a text with letters and a language."""
    known = docs.filter(F.col("lang").isNotNull() & _lettered()).select("doc_id", "text", "lang", F.xxhash64("doc_id").alias("turn"))
    per_language = known.select("lang", "turn", "doc_id").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    each = max(CENTROIDS, sample // max(1, len(per_language)))
    top = Window.partitionBy("lang").orderBy("turn", "doc_id")
    # Ids that cannot be among the first are left out where they lie, so a language with most of the rows sends no more than others.
    limits = docs.sparkSession.createDataFrame([(r["lang"], _up_to(each, r["n"])) for r in per_language], "lang string, most long")
    ids = known.select("lang", "turn", "doc_id").join(F.broadcast(limits), "lang").filter(F.col("turn") <= F.col("most")).select("lang", "turn", "doc_id").distinct()
    ids = ids.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= each).select("lang", "turn", "doc_id")
    # At most ``each`` rows a language.
    rows = known.join(F.broadcast(ids), ["lang", "turn", "doc_id"]).select("lang", "turn", "doc_id", "text")
    schema = pa.schema([("lang", pa.string()), ("turn", pa.int64()), ("used", pa.binary()), ("often", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("turn"), pa.array([u.tobytes() for u, _ in found], pa.binary()), pa.array([o.tobytes() for _, o in found], pa.binary())], schema=schema
            )

    table = rows.mapInArrow(run, "lang string, turn long, used binary, often binary").toPandas().sort_values(["lang", "turn", "used"], kind="stable")
    found = [(np.frombuffer(u, np.uint16), np.frombuffer(o, np.float32)) for u, o in zip(table["used"], table["often"])]
    return fit(found, table["lang"].tolist(), *document_frequencies(known))


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lettered = np.array(part.column(2).to_pylist(), dtype=bool)
                names, score, far = shared.value.predict([counts(t.as_py() if ok else None) for t, ok in zip(part.column(1), lettered)])
                names = [n if ok else UNKNOWN for n, ok in zip(names, lettered)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(np.where(lettered, score, 0.0)), pa.array(far | ~lettered)], schema=schema
                )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("lettered", _lettered())
    return own.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
