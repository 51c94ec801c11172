"""Embedding near-duplicates by a random-projection tree forest.

Each tree splits vectors along random directions near the median, again and again, until a leaf is
small; vectors close to a split go to both sides. Only vectors that share a leaf in some tree are
compared, exactly and in double precision, and the links are joined into components.

Splits are fitted on a bounded sample of each node that is still too large, and every vector is then
sent down them; that repeats until no node is too large, so trees grow with the data. Vectors of one
direction are one vector with a count, whatever their lengths, so no leaf is full of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursepulse.llm.folders import working_dir
from coursepulse.llm.graph import components
from coursepulse.llm.text import mix
from coursepulse.workspace import stored

SIMILARITY = 0.9
TREES = 10
#: Leaves hold up to so many vectors.
LEAF = 1024
#: Share of a node's vectors on each side of the median that go to both children.
SPILL = 0.06
#: Vectors of a node on which its splits are fitted; the fewest that a split may be fitted on.
SAMPLE, FEWEST = 16_384, 48
#: Nodes whose splits travel together to the executors, at most 16 bytes for each split.
MOST_NODES = 512


def directions(tree: int, depth: int, levels: int, size: int) -> np.ndarray:
    """Random directions of some levels of a tree, one column each."""
    return np.stack([np.random.default_rng([tree, depth + level, size]).normal(size=size)
                     for level in range(levels)], 1)


def fit_splits(projected: np.ndarray, most: int) -> dict[int, tuple[float, float]]:
    """Splits of a node from its sample, projected on one direction per level.

    Keys are heap positions below the node (1 is the node). A vector under the upper bound goes left,
    one over the lower bound right. ``most`` is how many of the sample may stay together.
    """
    splits: dict[int, tuple[float, float]] = {}
    todo = [(1, np.arange(len(projected)))]
    while todo:
        at, rows = todo.pop()
        level = at.bit_length() - 1
        if len(rows) <= max(most, FEWEST) or level >= projected.shape[1]:
            continue
        values = projected[rows, level]
        low, high = np.quantile(values, [0.5 - SPILL, 0.5 + SPILL])
        if values.min() == values.max():
            continue  # equal in this direction: nothing to split
        splits[at] = (low, high)
        todo.append((2 * at, rows[values <= high]))
        todo.append((2 * at + 1, rows[values >= low]))
    return splits


def descend(projected: np.ndarray, splits: dict[int, tuple[float, float]]):
    """Row numbers and the heap positions where they end; rows near a split end in several."""
    done_rows, done_at = [], []
    todo = [(1, np.arange(len(projected)))]
    while todo:
        at, rows = todo.pop()
        if not len(rows):
            continue
        split = splits.get(at)
        if split is None:
            done_rows.append(rows)
            done_at.append(np.full(len(rows), at))
            continue
        values = projected[rows, at.bit_length() - 1]
        todo.append((2 * at, rows[values <= split[1]]))
        todo.append((2 * at + 1, rows[values >= split[0]]))
    if not done_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(done_rows), np.concatenate(done_at)


def _unit(vectors) -> np.ndarray:
    stacked = np.stack([np.asarray(vector, dtype=np.float64) for vector in vectors])
    scaled = stacked / np.abs(stacked).max(axis=1, keepdims=True)  # squares can't overflow
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _direction(vector: str) -> Column:
    """A vector's components over its largest one, to 12 digits: vectors that differ in length alone have
    the same, but for rounding. The largest is put beside each component, else it is sought for each."""
    largest = F.nullif(F.array_max(F.transform(vector, F.abs)), F.lit(0.0))
    beside = F.array_repeat(largest, F.size(vector))
    return F.zip_with(vector, beside, lambda x, most: F.floor(x / most * 1e12 + 0.5))


def _child(node: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for the node at heap position ``at`` below ``node``."""
    return mix(node.view(np.uint64) ^ mix(at.astype(np.uint64))).view(np.int64)


_ROWS = "id long, copies long, vector array<float>, tree int, depth int, node long"
_LEVELS = 24


class EmbeddingLinks:
    """Links between a table's vectors and what they connect.

    ``vec_id, embedding`` are read, other columns ignored. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing; vectors link only with others of their length.
    Rows without an id are left out, and rows that repeat an id count once, as the one with the
    smallest digest.
    """

    def __init__(self, vectors: DataFrame, similarity: float = SIMILARITY):
        self.spark = vectors.sparkSession
        self.similarity = similarity
        rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("exact"),
                              F.col("embedding").cast("array<float>").alias("vector")
                              ).filter(F.col("vec_id").isNotNull())
        usable = F.coalesce(F.size("exact") > 0, F.lit(False)) & F.coalesce(F.forall(
            "exact", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
            F.lit(False)) & F.coalesce(F.exists("exact", lambda x: x != 0), F.lit(False))
        rows = rows.withColumn("usable", usable).withColumn("direction", _direction("exact"))
        rows = rows.withColumns({
            "high": F.when(F.col("usable"), F.xxhash64("direction")),
            "low": F.when(F.col("usable"), F.xxhash64("direction", F.lit(1)))}).drop("direction")
        keys = rows.groupBy("vec_id").agg(F.min(F.struct("high", "low")).alias("key"))
        keys = keys.select("vec_id", "key.high", "key.low")
        groups = keys.filter(F.col("high").isNotNull()).groupBy("high", "low").agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
        self.members = self._stored(keys.join(groups, ["high", "low"], "left").select(
            "vec_id", F.col("id"), "copies", "high", "low"), "members")
        heads = self.members.filter(F.col("vec_id") == F.col("id"))
        self.heads = self._stored(
            rows.select("vec_id", "high", "low", "exact").join(
                heads, ["vec_id", "high", "low"]).groupBy("vec_id").agg(
                F.first("copies").alias("copies"), F.first("exact").alias("vector"))
            .withColumnRenamed("vec_id", "id"), "heads")
        self._compare(self._leaves())

    def _stored(self, rows: DataFrame, label: str) -> DataFrame:
        return stored(rows, working_dir(self.spark, label))

    def _leaves(self) -> DataFrame:
        """``id, tree, node`` of all trees, with nodes of at most LEAF vectors where vectors differ."""
        sizes = F.size("vector")
        start = self.heads.select("id", F.explode(F.array(
            *[F.lit(tree) for tree in range(TREES)])).alias("tree"), F.lit(0).alias("depth"),
            F.xxhash64("tree", sizes).alias("node"), sizes.alias("size"))
        open_rows, leaves = start, []
        while True:
            counts = open_rows.groupBy("node", "tree", "depth", "size").agg(
                F.count(F.lit(1)).alias("rows"))
            counts = self._stored(counts, "nodes")
            large = counts.filter(F.col("rows") > LEAF)
            leaves.append(open_rows.join(
                large.select("node"), "node", "left_anti").select("id", "tree", "node"))
            blocks = -(-large.count() // MOST_NODES)
            if not blocks:
                break
            large = self._stored(large.withColumn(
                "block", F.pmod(F.xxhash64("node"), F.lit(blocks))), "nodes")
            parts = []
            for block in range(blocks):
                rows = open_rows.join(F.broadcast(  # MOST_NODES rows or so
                    large.filter(F.col("block") == block).select("node", "rows")), "node")
                rows = rows.join(self.heads.select("id", "vector"), "id")
                parts.append(self._split(self._stored(rows, "open")))
            open_rows = self._stored(reduce(DataFrame.unionAll, parts), "open")
            leaves.append(open_rows.filter(F.col("depth") < 0).select("id", "tree", "node"))
            open_rows = open_rows.filter(F.col("depth") >= 0)
        return reduce(DataFrame.unionAll, leaves)

    def _split(self, rows: DataFrame) -> DataFrame:
        """Rows in the children of their nodes; depth -1 where a node can't be split."""
        order = Window.partitionBy("node").orderBy(F.xxhash64("id", "node"), "id")
        sample = rows.withColumn("place", F.row_number().over(order)).filter(
            F.col("place") <= SAMPLE)

        def fit(group: pd.DataFrame) -> pd.DataFrame:
            first = group.iloc[0]
            unit = _unit(group["vector"])
            projected = unit @ directions(int(first["tree"]), int(first["depth"]), _LEVELS,
                                          unit.shape[1])
            most = int(LEAF * min(1.0, len(group) / first["rows"]))
            splits = fit_splits(projected, most)
            return pd.DataFrame({
                "node": int(first["node"]), "at": list(splits),
                "low": [low for low, _ in splits.values()],
                "high": [high for _, high in splits.values()]})

        fitted: dict[int, dict[int, tuple[float, float]]] = {}
        for row in sample.groupBy("node").applyInPandas(
                fit, "node long, at long, low double, high double").toLocalIterator():
            fitted.setdefault(row["node"], {})[row["at"]] = (row["low"], row["high"])

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for (node, tree, depth, size), group in batch.groupby(
                        ["node", "tree", "depth", "size"]):
                    splits = fitted.get(node, {})
                    unit = _unit(group["vector"])
                    levels = max((at.bit_length() for at in splits), default=0)
                    projected = unit @ directions(tree, depth, levels, size) if levels else unit
                    which, at = descend(projected, splits)
                    yield pd.DataFrame({
                        "id": group["id"].to_numpy()[which], "tree": tree,
                        "depth": np.where(at == 1, -1, depth + np.array(
                            [int(a).bit_length() - 1 for a in at])),
                        "node": np.where(at == 1, node, _child(
                            np.full(len(at), node, np.int64), at)), "size": size})

        return rows.select("id", "vector", "tree", "depth", "node", "size").mapInPandas(
            send, "id long, tree int, depth int, node long, size int")

    def _compare(self, leaves: DataFrame) -> None:
        """Counts each vector's links and connects linked vectors, leaf by leaf.

        A pair that shares several leaves counts in the first of them alone, so no list of pairs is
        needed to tell them apart. A leaf gives one row per linked vector.
        """
        leaves = self._stored(leaves, "leaves")
        homes = leaves.groupBy("id").agg(F.sort_array(F.collect_list("node")).alias("homes"))
        rows = leaves.select("id", "node").join(
            self.heads.join(homes, "id"), "id")
        similarity = self.similarity

        def compare(group: pd.DataFrame) -> pd.DataFrame:
            return _leaf_links(group, similarity)

        found = self._stored(rows.groupBy("node").applyInPandas(
            compare, "id long, links long, other long"), "links")
        self.counts = found.groupBy("id").agg(F.sum("links").alias("links"))
        self.found = components(found, "id", "other")

    def result(self) -> DataFrame:
        """``vec_id, n_links, component_id, kept``, one row per id."""
        joined = self.members.select("vec_id", "id", "copies").join(
            self.counts, "id", "left").join(self.found, "id", "left")
        component = F.coalesce("component", "id", "vec_id")
        return joined.select(
            "vec_id",
            (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _leaf_links(group: pd.DataFrame, similarity: float, step: int = 256) -> pd.DataFrame:
    """Per linked vector of a leaf: how many vectors its links, first found here, reach, and the
    smallest id it is connected with inside the leaf."""
    group = group.sort_values("id", kind="stable").drop_duplicates("id")
    ids, copies, node = group["id"].to_numpy(), group["copies"].to_numpy(), group["node"].iloc[0]
    unit = _unit(group["vector"])
    homes = group["homes"].to_numpy()
    width = max(len(found) for found in homes)
    # nodes before this one in which a vector also is, padded by numbers nothing shares
    earlier = np.empty((len(ids), width), np.int64)
    for at, found in enumerate(homes):
        found = np.asarray(found)
        earlier[at, : len(found)] = np.where(found < node, found, -1 - at)
        earlier[at, len(found):] = -1 - at
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    heads, tails = [], []
    for start in range(0, len(ids), step):
        cosines = unit[start : start + step] @ unit.T
        a, b = np.nonzero(cosines >= similarity)
        a += start
        a, b = a[a < b], b[a < b]
        heads.append(a)
        tails.append(b)
        for low in range(0, len(a), 20_000):
            i, j = a[low : low + 20_000], b[low : low + 20_000]
            mine, other = earlier[i], earlier[j]
            known = np.zeros(len(i), bool)
            for place in range(width):
                known |= (other == mine[:, place : place + 1]).any(axis=1)
            i, j = i[~known], j[~known]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
    a, b = np.concatenate(heads), np.concatenate(tails)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    linked = np.unique(np.concatenate([a, b]))
    return pd.DataFrame({"id": ids[linked], "links": links[linked], "other": ids[label[linked]]})
