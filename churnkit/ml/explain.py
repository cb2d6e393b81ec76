"""Signed contributions of each input to a boosted-tree score (Shapley values over the tree paths).

The model is a few thousand numbers: it is stored, read back as a table of nodes and shipped to the
tasks as tables of what its leaves contribute together (some 16 kB for half a tree). Rows never leave their partition; each Arrow batch is explained with array arithmetic.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions below travel with the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Spark's boosted classifier has probability 1 / (1 + exp(-2 * margin)), so log-odds are twice the margin.
LOG_ODDS_PER_MARGIN = 2.0
#: Tests of leaves that are looked up together (their table has two to that power columns), and rows that are looked up at a time.
JOINT_TESTS, BLOCK_ROWS = 8, 2048


def node_table(model, path: str) -> DataFrame:
    """Store the model under a shared folder and read its nodes: one row per tree node."""
    model.write().overwrite().save(path)
    return stored_nodes(SparkSession.active(), path)


def stored_nodes(spark: SparkSession, path: str) -> DataFrame:
    nodes = spark.read.parquet(f"{path}/data")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "tree_weight").drop("metadata")
    node = F.col("nodeData")
    return nodes.join(weights, "treeID").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["prediction"].alias("value"),
        node["rawCount"].alias("cover"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature_index"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        "tree_weight",
    )


@dataclass
class Leaf:
    """The tests on the way to a leaf, the place in ``inputs`` each belongs to, and the contributions by set of inputs passed."""

    inputs: np.ndarray
    tests: list[tuple[int, int, float, bool]]
    table: np.ndarray
    base: float


def leaf_of(value: float, path: Sequence[tuple[int, float, bool, float]]) -> Leaf:
    """A leaf from its value and the steps to it: input, threshold, whether the path goes left, and the share of rows that take it."""
    inputs = list(dict.fromkeys(feature for feature, *_ in path))
    shares = [math.prod(share for feature, _, _, share in path if feature == f) for f in inputs]
    tests = [(inputs.index(feature), feature, threshold, left) for feature, threshold, left, _ in path]
    return Leaf(np.array(inputs, dtype=int), tests, np.ascontiguousarray(mask_table(value, shares).T), value * math.prod(shares))


def mask_table(value: float, shares: Sequence[float]) -> np.ndarray:
    """Contribution of each of m inputs for each of the 2^m sets of inputs whose tests a row passes.

    A leaf counts fully for a known input whose tests pass, not at all for a known one whose tests fail, and by its cover share
    for an unknown one. The mean over all orders in which inputs become known needs only how many of the others are known, so the weights of
    the products are summed by degree: multiply out (share + passed * t) over the other inputs, and weight t^k by k! (m - 1 - k)! / m!.
    """
    m = len(shares)
    order = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    out = np.zeros((1 << m, m))
    for mask in range(1 << m):
        for j in range(m):
            product = np.array([1.0])
            for i in range(m):
                if i != j:
                    product = np.convolve(product, [shares[i], float(mask >> i & 1)])
            out[mask, j] = value * (float(mask >> j & 1) - shares[j]) * float(product @ order)
    return out


def leaf_paths(nodes: pd.DataFrame) -> list[Leaf]:
    """All leaves of a stored model."""
    leaves = []
    for _, tree in nodes.groupby("tree"):
        at = {row["node"]: row for row in tree.to_dict("records")}
        stack: list[tuple[int, list]] = [(0, [])]
        while stack:
            number, path = stack.pop()
            row = at[number]
            if row["left"] >= 0:
                for child, left in ((row["left"], True), (row["right"], False)):
                    share = float(at[child]["cover"]) / float(row["cover"])
                    stack.append((child, [*path, (int(row["feature_index"]), float(row["threshold"]), left, share)]))
                continue
            leaves.append(leaf_of(float(row["value"]) * float(row["tree_weight"]) * LOG_ODDS_PER_MARGIN, path))
    return leaves


@dataclass
class Joint:
    """Leaves that share tests (input, threshold), and their contributions by the set of tests a row passes, added up."""

    inputs: np.ndarray
    tests: list[tuple[int, float]]
    table: np.ndarray
    base: float


def joined(leaves: Sequence[Leaf]) -> list[Joint]:
    """Neighbouring leaves put together as long as they have no more than ``JOINT_TESTS`` tests between them: half a tree of depth four."""
    groups: list[tuple[list[Leaf], dict[tuple[int, float], int]]] = []
    for leaf in leaves:
        own = [(feature, threshold) for _, feature, threshold, _ in leaf.tests]
        if groups and len({*groups[-1][1], *own}) <= max(JOINT_TESTS, len(groups[-1][1])):
            group, places = groups[-1]
        else:
            group, places = [], {}
            groups.append((group, places))
        group.append(leaf)
        for test in own:
            places.setdefault(test, len(places))
    return [_joint(group, places) for group, places in groups]


def _joint(leaves: Sequence[Leaf], places: dict[tuple[int, float], int]) -> Joint:
    inputs = np.unique(np.concatenate([leaf.inputs for leaf in leaves]))
    codes = np.arange(1 << len(places))
    table = np.zeros((len(inputs), len(codes)))
    for leaf in leaves:
        failed = np.zeros(len(codes), dtype=np.int64)
        for place, feature, threshold, left in leaf.tests:
            failed |= ((codes >> places[feature, threshold] & 1) != left).astype(np.int64) << place
        table[np.searchsorted(inputs, leaf.inputs)] += leaf.table[:, failed ^ ((1 << len(leaf.inputs)) - 1)]
    return Joint(inputs, list(places), table, sum(leaf.base for leaf in leaves))


def shapley(x: np.ndarray, leaves: Sequence[Leaf]) -> tuple[np.ndarray, float]:
    """Contribution of every input for every row of ``x``, and the base value they add up from."""
    return looked_up(x, joined(leaves))


def looked_up(x: np.ndarray, joints: Sequence[Joint]) -> tuple[np.ndarray, float]:
    """The same from joined leaves: each different test once a row, one look-up a row and joint."""
    tests = {test: i for i, test in enumerate(dict.fromkeys(test for joint in joints for test in joint.tests))}
    features = np.array([feature for feature, _ in tests], dtype=int)
    thresholds = np.array([threshold for _, threshold in tests], dtype=float)[:, None]
    at = [np.array([tests[test] for test in joint.tests], dtype=int) for joint in joints]
    out = np.zeros(x.shape)
    for first in range(0, len(x), BLOCK_ROWS):
        by_input = np.ascontiguousarray(x[first : first + BLOCK_ROWS].T)
        passed, phi = by_input[features] <= thresholds, np.zeros(by_input.shape)
        for joint, own in zip(joints, at):
            code = np.zeros(by_input.shape[1], dtype=np.int64)
            for k in range(0, len(own), 8):
                code |= np.packbits(passed[own[k : k + 8]], axis=0, bitorder="little")[0].astype(np.int64) << k
            phi[joint.inputs] += joint.table.take(code, axis=1)
        out[first : first + BLOCK_ROWS] = phi.T
    return out, float(sum(joint.base for joint in joints))


def contributions(df: DataFrame, nodes: DataFrame, inputs: Sequence[str], name: str = "contributions") -> DataFrame:
    """Add a map of input name to signed log-odds contribution, and the base value they add up from."""
    # Bounded by the model: number of trees times 2 ** (depth + 1) nodes.
    joints = df.sparkSession.sparkContext.broadcast(joined(leaf_paths(nodes.toPandas())))
    inputs = list(inputs)
    plain = [f for f in df.schema.fields if f.name not in ("features", "rawPrediction")]
    schema = T.StructType(
        [*plain, T.StructField("_phi", T.ArrayType(T.DoubleType())), T.StructField("base_value", T.DoubleType())]
    )

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            phi, base = looked_up(batch[inputs].to_numpy(dtype=float), joints.value)
            yield batch.assign(_phi=list(phi), base_value=base)

    explained = df.select(*[f.name for f in plain]).mapInPandas(explain, schema)
    return explained.withColumn(
        name, F.map_from_arrays(F.array(*[F.lit(n) for n in inputs]), F.col("_phi"))
    ).drop("_phi")
