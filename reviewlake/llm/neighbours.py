"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits the space at hyperplanes between the means of two groups of a random
draw, at the median, down to leaves. The trees are grown, one task each, on a sample of at
most ``SAMPLE`` vectors, a documented bound, so the forest that is broadcast is bounded
too. Every vector is then sent down every tree. A query searches all trees through one
priority queue of nodes, ordered by the distance to the nearest hyperplane on the wrong
side, until the leaves it has reached hold about ``search_rows`` vectors. These candidates
are ranked by the exact cosine in double precision.

How many vectors that must be for a recall of ``RECALL`` depends on the table, so it is
found on the table itself: for ``CALIBRATION`` queries, a documented bound, the exact
neighbours are found by one scan, and the forest tells how many vectors each query must
look at until it meets them.

* Equal vectors are one item with its ``k + 1`` smallest ids, cut in each task before the
  shuffle, which is all that a query can need; a vector that a third of all rows hold is
  one item.
* Leaves and the queries that reach them are cut into blocks of bounded size, by counted
  sizes, and joined on the leaf. Of the pairs of blocks that a task compares, a query's
  ``k + 1`` nearest items are handed on, and of all of these the ``k + 1`` nearest: one may be
  its own, and each other one holds an id at least, so these hold the ``k`` nearest ids.

On vectors without structure the number grows nearly with the table, and the work with its
square; leaves grow with the root of the table, so that queries reach fewer of them. The
README has the recall measured.

Defined results: rows without id, and vectors that are null, zero, empty or hold null or
non-finite components, take no part; a shorter vector counts as filled up with zeros; an
id that several rows have counts once, with the least of its vectors; of equal cosines the
smaller id is nearer; an empty table gives an empty result; other columns are not returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..scratch import materialize, materialize_counted
from .common import table

SAMPLE = 20_000
TREES = 32
LEAF_ROWS = 64
RECALL, CALIBRATION = 0.95, 512
#: Up to so many vectors leaves hold ``LEAF_ROWS``.
LEAF_ROWS_TO = 50_000
ITEM_BLOCK, QUERY_BLOCK = 2048, 256
#: Rows that a task holds back to hand on the nearest of each query alone.
HELD = 200_000


@dataclass
class Tree:
    """Inner nodes, with children; a negative child is a leaf, ``-1 - number``."""

    normals: np.ndarray
    offsets: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sizes: np.ndarray


def grow(vectors: np.ndarray, leaf: int, seed: int) -> Tree:
    rng = np.random.default_rng(seed)
    normals, offsets, low, high, sizes = [], [], [], [], []

    def split(rows: np.ndarray) -> int:
        if len(rows) <= leaf:
            sizes.append(len(rows))
            return -len(sizes)
        some = vectors[rng.choice(rows, min(len(rows), 256), replace=False)]
        a, b = some[0].copy(), some[1].copy()
        for _ in range(4):
            near_a = some @ (a - b) > (a @ a - b @ b) / 2
            if near_a.all() or not near_a.any():
                break
            a, b = some[near_a].mean(axis=0), some[~near_a].mean(axis=0)
        normal = a - b
        length = np.linalg.norm(normal)
        normal = normal / length if length > 0 else rng.standard_normal(vectors.shape[1]).astype(np.float32)
        at = vectors[rows] @ normal
        offset = np.median(at)
        above = at > offset
        if above.all() or not above.any():
            sizes.append(len(rows))
            return -len(sizes)
        me = len(normals)
        normals.append(normal)
        offsets.append(offset)
        low.append(0)
        high.append(0)
        low[me], high[me] = split(rows[~above]), split(rows[above])
        return me

    split(np.arange(len(vectors)))
    return Tree(
        np.array(normals, dtype=np.float32).reshape(len(normals), vectors.shape[1]),
        np.array(offsets, dtype=np.float32),
        np.array(low, dtype=np.int64),
        np.array(high, dtype=np.int64),
        np.array(sizes, dtype=np.int64),
    )


@dataclass
class Forest:
    trees: list[Tree]
    rows_per_sample: float

    def __post_init__(self) -> None:
        self.first = np.cumsum([0, *[len(t.sizes) for t in self.trees]]).tolist()

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree, numbered over all trees."""
        out = np.empty((len(vectors), len(self.trees)), dtype=np.int64)
        for t, tree in enumerate(self.trees):
            at = np.full(len(vectors), 0 if len(tree.low) else -1, dtype=np.int64)
            while len(inner := np.flatnonzero(at >= 0)):
                node = at[inner]
                above = np.einsum("ij,ij->i", vectors[inner], tree.normals[node]) > tree.offsets[node]
                at[inner] = np.where(above, tree.high[node], tree.low[node])
            out[:, t] = self.first[t] - 1 - at
        return out

    def needed(self, vector: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """How many vectors ``search`` looks at before it reaches one of each row's ``leaves``."""
        bounds, sizes = [], []
        for tree in self.trees:
            margin = tree.normals @ vector - tree.offsets
            bound = np.zeros(len(tree.sizes))
            nodes, at = np.array([0 if len(tree.low) else -1]), np.zeros(1)
            while len(nodes):
                leaf = nodes < 0
                bound[-1 - nodes[leaf]] = at[leaf]
                nodes, at = nodes[~leaf], at[~leaf]
                m, wrong = margin[nodes], np.maximum(at, np.abs(margin[nodes]))
                at = np.concatenate([np.where(m > 0, wrong, at), np.where(m > 0, at, wrong)])
                nodes = np.concatenate([tree.low[nodes], tree.high[nodes]])
            bounds.append(bound)
            sizes.append(tree.sizes)
        order = np.argsort(np.concatenate(bounds), kind="stable")
        held = np.cumsum(np.concatenate(sizes)[order]) * self.rows_per_sample
        before = np.empty(len(order))
        before[order] = np.concatenate([[0.0], held[:-1]])
        return before[leaves].min(axis=1)

    def search(self, vector: np.ndarray, rows: int) -> list[int]:
        """Leaves in the order of the shared queue, until they hold about ``rows`` vectors."""
        margins = [tree.normals @ vector - tree.offsets for tree in self.trees]
        queue = [(0.0, t, 0 if len(tree.low) else -1) for t, tree in enumerate(self.trees)]
        found, held = [], 0.0
        while queue and held < rows:
            bound, t, node = heapq.heappop(queue)
            tree, margin = self.trees[t], margins[t]
            while node >= 0:
                m = float(margin[node])
                near, far = (tree.high, tree.low) if m > 0 else (tree.low, tree.high)
                heapq.heappush(queue, (max(bound, abs(m)), t, int(far[node])))
                node = int(near[node])
            found.append(self.first[t] - 1 - node)
            held += float(tree.sizes[-1 - node]) * self.rows_per_sample
        return found


def matrix(column: pa.Array, size: int, kind=np.float64) -> np.ndarray:
    """Vectors of a list column, filled up with zeros to ``size``."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    if len(lengths) and (lengths == size).all():
        return flat.reshape(len(lengths), size).astype(kind)
    out = np.zeros((len(lengths), size), dtype=kind)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def usable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def forest(items: DataFrame, n: int, dimensions: int, trees: int) -> Forest:
    spark = items.sparkSession
    # Bounded: SAMPLE rows at most, those with the smallest hashes.
    drawn = items.select("item", "vector").orderBy(F.xxhash64("item"), "item").limit(SAMPLE).toArrow()
    drawn = drawn.combine_chunks().sort_by("item")
    chunk = drawn["vector"].combine_chunks()
    sample = unit(matrix(chunk, dimensions)) if len(drawn) else np.empty((0, dimensions), np.float32)
    leaf_rows = LEAF_ROWS * max(1.0, n / LEAF_ROWS_TO) ** 0.5
    leaf = max(1, round(leaf_rows * len(drawn) / max(n, 1)))
    shared = spark.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        for batch in batches:
            for t in batch.column("id").to_pylist():
                tree = pickle.dumps(grow(shared.value, leaf, t))
                yield pa.RecordBatch.from_arrays([pa.array([t]), pa.array([tree], pa.binary())], ["id", "tree"])

    import pickle

    grown = spark.range(0, trees, 1, trees).mapInArrow(run, "id long, tree binary").collect()
    return Forest([pickle.loads(row["tree"]) for row in sorted(grown)], n / max(len(drawn), 1))


def rows_to_search(queries: DataFrame, items: DataFrame, shared, dimensions: int, k: int) -> int:
    """How many vectors a query must look at for a recall of ``RECALL``, from exact neighbours."""
    # Bounded: CALIBRATION rows at most, those with the smallest hashes.
    drawn = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(CALIBRATION).toArrow().combine_chunks()
    if not len(drawn):
        return 1
    asked = unit(matrix(drawn["vector"].combine_chunks(), dimensions))
    spark = queries.sparkSession
    questions = spark.sparkContext.broadcast(asked)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = unit(matrix(batch.column("vector"), dimensions))
            cosines = questions.value @ vectors.T
            # One more than k, as the query's own vector is among them.
            m = min(k + 1, len(batch))
            near = np.argpartition(-cosines, m - 1, axis=1)[:, :m]
            q, i = np.repeat(np.arange(len(cosines)), m), near.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(q), pa.array(cosines[q, i]), batch.column("item").take(pa.array(i)), batch.column("vector").take(pa.array(i))],
                ["q", "score", "item", "vector"],
            )

    def needs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = batch.column("q").to_numpy()
            leaves = shared.value.leaves(unit(matrix(batch.column("vector"), dimensions))) if len(q) else None
            need = np.zeros(len(q))
            for one in np.unique(q):
                need[q == one] = shared.value.needed(questions.value[one], leaves[q == one])
            yield pa.RecordBatch.from_arrays([pa.array(need)], ["need"])

    kind = items.schema["vector"].dataType.simpleString()
    order = Window.partitionBy("q").orderBy(F.desc("score"), "item")
    nearest_ones = (
        items.select("item", "vector")
        .mapInArrow(scan, f"q long, score float, item long, vector {kind}")
        .withColumn("_rn", F.row_number().over(order))
        .where((F.col("_rn") > 1) & (F.col("_rn") <= k + 1))
    )
    need = nearest_ones.select("q", "vector").mapInArrow(needs, "need double").toArrow()["need"].to_numpy()
    return int(np.quantile(need, RECALL, method="higher")) + 1 if len(need) else 1


def in_blocks(places: DataFrame, vectors: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """``leaf`` and ``name``, an array of at most about ``size`` of its rows of ``vectors``."""
    counts = places.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    dealt = places.join(counts, "leaf").withColumn("part", F.pmod(F.xxhash64(key), F.col("parts")))
    row = F.struct(*vectors.columns)
    return dealt.join(vectors, key).groupBy("leaf", "part").agg(F.collect_list(row).alias(name)).drop("part")


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of the pairs of rows, the same whatever stands beside them."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def best_of(rows: pa.Table, most: int) -> pa.Table:
    """The ``most`` nearest items of each query, each once."""
    q, item, score = (rows[c].to_numpy() for c in ("query_id", "item", "score"))
    order = np.lexsort((item, -score, q))
    q, item = q[order], item[order]
    # An item has the same score wherever a query meets it, so its rows adjoin.
    new = np.ones(len(q), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (item[1:] != item[:-1])
    order, q = order[new], q[new]
    place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    return rows.take(pa.array(order[place < most]))


def ranked(pairs: DataFrame, dimensions: int, k: int) -> DataFrame:
    """``query_id, item, ids, score`` of the ``k + 1`` nearest items in the pairs of blocks of a task."""

    def near_in(queries: pa.ListScalar, items: pa.ListScalar) -> pa.RecordBatch:
        q, x = queries.values, items.values
        qv, xv = (matrix(lists_of(v, "vector"), dimensions) for v in (q, x))
        q_ids, x_ids = q.field("query_id").to_numpy(), x.field("item").to_numpy()
        norms = np.linalg.norm(xv, axis=1)
        cosines = (qv / np.linalg.norm(qv, axis=1, keepdims=True)) @ (xv / norms[:, None]).T
        ids = lists_of(x, "ids")
        alone = np.diff(ids.offsets.to_numpy()) == 1
        cosines[(q_ids[:, None] == x_ids[None, :]) & alone[None, :]] = -np.inf
        # A few more than k, as the last digits of a matrix product vary.
        m = min(k + 4, len(x_ids))
        near = np.argpartition(-cosines, m - 1, axis=1)[:, :m]
        rows, cols = np.repeat(np.arange(len(q_ids)), m), near.ravel()
        real = np.isfinite(cosines[rows, cols])
        rows, cols = rows[real], cols[real]
        score = exact(qv[rows], xv[cols])
        order = np.lexsort((x_ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        best = place <= k
        rows, cols, score = rows[best], cols[best], score[best]
        return pa.RecordBatch.from_arrays(
            [pa.array(q_ids[rows]), pa.array(x_ids[cols]), ids.take(pa.array(cols)), pa.array(score)],
            ["query_id", "item", "ids", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for queries, items in zip(batch.column("queries"), batch.column("items"), strict=True):
                held.append(near_in(queries, items))
                n += len(held[-1])
                if n > HELD:
                    best = best_of(pa.Table.from_batches(held), k + 1)
                    if 2 * len(best) > HELD:
                        yield from best.to_batches()
                        best = best.slice(0, 0)
                    held, n = best.to_batches(), len(best)
        if n:
            yield from best_of(pa.Table.from_batches(held), k + 1).to_batches()

    return pairs.select("queries", "items").mapInArrow(run, "query_id long, item long, ids array<long>, score double")


def lists_of(rows: pa.StructArray, name: str) -> pa.ListArray:
    column = rows.field(name)
    return pa.concat_arrays([column]) if isinstance(column, pa.ListArray) else column.cast(pa.list_(column.type.value_type))


def nearest(
    table: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, search_rows: int | None = None
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``table`` (``vec_id, embedding``) that are queries.

    Without ``search_rows`` a query looks at as many vectors as ``RECALL`` takes.
    """
    spark = table.sparkSession
    rows = (
        table.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min("embedding").alias("vector"))
    )
    rows = materialize(rows)
    first = Window.partitionBy("vector").orderBy("vec_id")
    items, n = materialize_counted(
        rows.withColumn("_rn", F.row_number().over(first))
        .where(F.col("_rn") <= k + 1)
        .groupBy("vector")
        .agg(F.min("vec_id").alias("item"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select("item", "ids", "vector")
    )
    dimensions = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    shared = spark.sparkContext.broadcast(forest(items, n, dimensions, trees))

    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    if search_rows is None:
        search_rows = rows_to_search(queries, items, shared, dimensions, k)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.leaves(unit(matrix(batch.column("vector"), dimensions)))
            ids = np.repeat(batch.column("item").to_numpy(), leaves.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(leaves.ravel()), pa.array(ids)], ["leaf", "item"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for q, vector in zip(
                batch.column("query_id").to_pylist(), unit(matrix(batch.column("vector"), dimensions)), strict=True
            ):
                found = shared.value.search(vector, search_rows)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([q] * len(found))], ["leaf", "query_id"])

    places = materialize(items.select("item", "vector").mapInArrow(place, "leaf long, item long"))
    reached = materialize(queries.repartition("query_id").mapInArrow(search, "leaf long, query_id long"))
    item_blocks = in_blocks(places, items, "item", ITEM_BLOCK, "items")
    query_blocks = in_blocks(reached, queries, "query_id", QUERY_BLOCK, "queries")
    found = ranked(query_blocks.join(item_blocks, "leaf"), dimensions, k)
    by_item, by_id = (Window.partitionBy("query_id").orderBy(F.desc("score"), c) for c in ("item", "vec_id"))
    return (
        found.groupBy("query_id", "item")
        .agg(F.first("ids").alias("ids"), F.max("score").alias("score"))
        .withColumn("_rn", F.row_number().over(by_item))
        .where(F.col("_rn") <= k + 1)
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(by_id))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 50 == 0)


QUERIES = {"op2_projection_forest": (op2_projection_forest, None)}
