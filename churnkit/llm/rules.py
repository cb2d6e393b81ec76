"""Quality rules: a decision list learned from labelled statistics, applied as ordered Spark conditions.

Statistics of each text are counted in one pass over Arrow batches. The list is learned by sequential covering: a rule is a conjunction
of thresholds, grown on two thirds of the labelled rows by information gain until it covers no good document, cut
back on the other third, and kept if it is precise there; what it covers is taken out and the next rule is learned. The result
is a chain of CASE conditions on ratios of the statistics: the first rule that holds rejects the document.

Learning looks at ``SAMPLE`` labelled rows at most (those of the smallest id hashes); statistics and verdicts are for all rows.

Null and empty texts count 0 everywhere and fail the base rule (fewer than 50 words). Labels that are null or name no document
are left out; without labels of both kinds the list is empty and only the base rule rejects. Repeated rows are judged one by one,
extra columns are kept by ``judge`` as they are, whatever their names, unless they are named like a statistic (then the statistic
replaces them); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import hashes_of, mixed, sampled, tidy

SAMPLE = 20_000
#: Least share of rejected documents among those that a rule covers, least number of them, and most conditions of a rule.
PRECISION, SUPPORT, CONDITIONS, RULES = 0.95, 8, 4, 12
#: Thresholds tried for a ratio at a time.
CUTS = 48

SYMBOLS = "#*$%&|<>"
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_digits", "n_same_words",
    "top_word",
)
#: Ratios the rules speak of: numerator and denominator.
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "digits_per_char": ("n_digits", "word_chars"),
    "same_word_share": ("n_same_words", "n_words"),
    "top_word_share": ("top_word", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}

_SYMBOL_BYTES = np.frombuffer(SYMBOLS.encode(), dtype=np.uint8)
_BLANK_BYTES = np.frombuffer(b" \t\n\v\f\r", dtype=np.uint8)


def statistics(text: str | None) -> tuple[int, ...]:
    """Counts of one text in the order of ``STATISTICS``."""
    if not text:
        return (0,) * len(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    by_byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    characters = int(by_byte[:0x80].sum() + by_byte[0xC0:].sum())
    lines = [line for line in raw.split(b"\n") if line.split(None, 1)]
    words = raw.split()
    n = len(words)
    h = hashes_of(words)
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    repeated = 0
    if n >= 3:
        with np.errstate(over="ignore"):
            windows = mixed(mixed(mixed(h[:-2]) + h[1:-1]) + h[2:])
        _, which, often = np.unique(windows, return_inverse=True, return_counts=True)
        again = often[which] > 1
        covered = np.zeros(n, dtype=bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= again
        repeated = int(covered.sum())
    return (
        n, characters - int(by_byte[_BLANK_BYTES].sum()), int(by_byte[_SYMBOL_BYTES].sum()), len(lines) - len(set(lines)), repeated,
        len(lines), len(counts), int(by_byte[48:58].sum()), int((h[1:] == h[:-1]).sum()), int(counts.max()) if n else 0,
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and the statistics of ``text``."""
    names = [c for c in docs.columns if c not in STATISTICS]
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    at = names.index("text")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields] + [f"{s} long" for s in STATISTICS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py()) for t in batch.column(at)]
            counted = np.array(rows, dtype=np.int64).reshape(len(rows), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(counted[:, k]) for k in range(len(STATISTICS)))], names=[*names, *STATISTICS])

    return kept.mapInArrow(tidy(run), schema)


def ratio(name: str) -> Column:
    top, bottom = RATIOS[name]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class Condition:
    """A ratio at or above, or below, a threshold."""

    name: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] >= self.threshold if self.above else values[self.name] < self.threshold

    def column(self) -> Column:
        return ratio(self.name) >= self.threshold if self.above else ratio(self.name) < self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covered(rule: Rule, values: dict[str, np.ndarray], size: int) -> np.ndarray:
    out = np.ones(size, dtype=bool)
    for condition in rule:
        out &= condition.holds(values)
    return out


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Conditions added one by one by FOIL's gain until no good row is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < CONDITIONS:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p or not n:
            break
        best, gain = None, 1e-9
        for name, column in values.items():
            here, is_bad = column[inside], bad[inside]
            cuts = np.unique(np.quantile(np.concatenate([here, here[is_bad]]), np.linspace(0, 1, CUTS)))
            cuts = (cuts[1:] + cuts[:-1]) / 2
            order = np.argsort(here)
            ranked, bads = here[order], np.concatenate([[0], np.cumsum(is_bad[order])])
            below = np.searchsorted(ranked, cuts)
            for above in (True, False):
                pos = bads[-1] - bads[below] if above else bads[below]
                all_ = len(here) - below if above else below
                with np.errstate(divide="ignore", invalid="ignore"):
                    gains = np.where(pos > 0, pos * (np.log2(pos / all_) - np.log2(p / (p + n))), -1.0)
                if len(gains) and gains.max() > gain:
                    best, gain = Condition(name, above, float(cuts[gains.argmax()])), gains.max()
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Beginnings of the rule, from the best to the worst on rows it was not grown on; of equal ones the shortest first."""
    found = []
    for size in range(1, len(rule) + 1):
        inside = _covered(rule[:size], values, len(bad))
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        found.append((-(p - n) / (p + n) if p + n else 1.0, size))
    return [rule[:size] for _, size in sorted(found)]


def learn(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules for bad rows; ``values`` holds a column per ratio, rows in any fixed order.

    Where no beginning of a grown rule is precise, its rows are set aside and the next rule is grown on the rest.
    """
    rules: list[Rule] = []
    turn = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), dtype=bool)
    for _ in range(RULES):
        if (left & bad).sum() < SUPPORT:
            break
        grow, prune = left & ~turn, left & turn
        of = lambda rows: {k: v[rows] for k, v in values.items()}
        grown = _grow(of(grow), bad[grow])
        if not grown:
            break
        for rule in _prune(grown, of(prune), bad[prune]):
            inside = left & _covered(rule, values, len(bad))
            if (inside & bad).sum() >= max(SUPPORT, PRECISION * inside.sum()):
                rules.append(rule)
                break
        else:
            inside = left & _covered(grown, values, len(bad))
        left &= ~inside
    return rules


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules from documents whose ``quality`` is 0 against those whose it is 1, on ``sample`` labelled documents at most."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("mark"))
    counted = with_statistics(sampled(docs, known, "mark", sample))
    table = counted.filter("n_words >= 50").select("turn", "doc_id", (F.col("mark") == 0).alias("bad"), *[ratio(r).alias(r) for r in RATIOS]).toPandas()
    table = table.sort_values(["turn", "doc_id", *RATIOS], kind="stable")
    return learn({r: table[r].to_numpy(dtype=float) for r in RATIOS}, table["bad"].to_numpy(dtype=bool))


def first_rule(rules: list[Rule]) -> Column:
    """Number (from 1) of the first rule that holds, 0 where none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        holds = rule[0].column()
        for condition in rule[1:]:
            holds &= condition.column()
        out = F.when(holds, number) if out is None else out.when(holds, number)
    return (out.otherwise(0) if out is not None else F.lit(0)).cast("int")


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """All columns, statistics, base_failed, rule (number of the rejecting rule or 0) and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = with_statistics(docs).withColumn("base_failed", failed).withColumn("rule", first_rule(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
