"""Ranked lexical search for many items at once, computing shared parts of them once.

Items often have terms in common. Which sets of terms they share is mined before any
document is scored, and every shared set becomes a node of a graph:

1. Terms that occur in just the same items are one leaf.
2. Among the items' lists of nodes, the pairs that stand together in most items become
   nodes of their own, in rounds, as long as a pair stands in two items or more.

For each slice of documents, the partial scores of all nodes are then filled in once, from
the leaves upwards, level by level, and an item's scores are the sum of the few nodes that
its list has come down to.

Two passes over the documents. The first counts the terms of each whole text, keeps the
counts of those that any item has, and writes them down as narrow rows. Over these the
document frequencies are counted, and the second pass scores them. Each task keeps the
``k`` best of each item, so what is shuffled does not depend on the length of texts.

Items are taken in blocks of about ``BLOCK_TERMS`` terms (an item of more is a block of
its own), each mined in a task; plan, terms and frequencies of a block are what the driver
holds and what is broadcast. Mining looks for pairs within ``SEGMENT`` nodes of an item,
the most frequent first, so that its work is in proportion to the terms; a pair that is not
found only means that a sum is made twice.

Defined results: a document is a row, so repeated rows are ranked one by one; rows of one
``item_id`` are one item with the terms of all; a null id is an id, and a null ``doc_id``
comes last among equal scores; a null or empty text has no terms, such a document is not
counted, and an item without terms, or with none that weighs, has no rows; equal scores
come by ascending ``doc_id``; an empty table on either side gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..scratch import materialize
from .common import table
from .line_dedup import LOWER, UPPER

#: Fixed value: a term is a run of characters other than the ASCII ones that are no letter or digit.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms of the items of a block, each as often as items have it.
BLOCK_TERMS = 100_000
#: Nodes of an item among which pairs are looked for.
SEGMENT = 256
#: Partial scores that are held at once.
CELLS = 4_000_000

#: Of bytes: what is no term becomes a space, A-Z lose their case.
_TERM_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256)
)


@dataclass
class Plan:
    """How the items of a block are put together.

    Nodes are numbered from the leaves upwards. ``leaf`` has the leaf of each term;
    ``levels`` has, level by level, the first node and the two parts of each node;
    ``parts`` has the nodes that make up each item.
    """

    items: list
    terms: list[str]
    leaf: np.ndarray
    n_nodes: int
    levels: list[tuple[int, np.ndarray, np.ndarray]]
    parts: list[np.ndarray]


def mined(items: list, terms_of: list[list[str]]) -> Plan:
    """The plan of these items."""
    terms = sorted(set().union(*terms_of))
    number = {t: i for i, t in enumerate(terms)}
    having: list[list[int]] = [[] for _ in terms]
    for i, own in enumerate(terms_of):
        for t in own:
            having[number[t]].append(i)
    leaves: dict[tuple[int, ...], int] = {}
    leaf = np.array([leaves.setdefault(tuple(h), len(leaves)) for h in having], dtype=np.int64)
    lists: list[list[int]] = [[] for _ in items]
    for have, node in sorted(leaves.items(), key=lambda x: (-len(x[0]), x[1])):
        for i in have:
            lists[i].append(node)
    segments = [(i, set(own[at : at + SEGMENT])) for i, own in enumerate(lists) for at in range(0, len(own), SEGMENT)]
    n_nodes, levels = len(leaves), []
    while pairs := frequent_pairs(n_nodes, [s for _, s in segments]):
        levels.append((n_nodes, np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        partner = {a: (b, n_nodes + j) for j, (a, b) in enumerate(pairs)}
        for _, own in segments:
            for a in [a for a in own if a in partner and partner[a][0] in own]:
                b, node = partner[a]
                own -= {a, b}
                own.add(node)
        n_nodes += len(pairs)
    parts: list[list[int]] = [[] for _ in items]
    for i, own in segments:
        parts[i] += sorted(own)
    return Plan(items, terms, leaf, n_nodes, levels, [np.array(p, dtype=np.int64) for p in parts])


def frequent_pairs(n_nodes: int, lists: list[set[int]]) -> list[tuple[int, int]]:
    """Pairs that two lists or more have, the most frequent first, no node in two of them."""
    keys = []
    for own in lists:
        nodes = np.sort(np.fromiter(own, dtype=np.int64, count=len(own)))
        a, b = np.triu_indices(len(nodes), 1)
        keys.append(nodes[a] * n_nodes + nodes[b])
    found, counts = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.array([]), np.array([]))
    found, counts = found[counts > 1], counts[counts > 1]
    taken: set[int] = set()
    pairs = []
    for key in found[np.lexsort((found, -counts))].tolist():
        a, b = divmod(key, n_nodes)
        if a not in taken and b not in taken:
            taken |= {a, b}
            pairs.append((a, b))
    return pairs


def item_scores(plan: Plan, weight: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> Iterator[np.ndarray]:
    """Of each item, its scores of documents ``0 .. len(m) - 1``; ``doc, term, tf`` are rows."""
    held = np.zeros((plan.n_nodes, len(m)), dtype=np.int64)
    part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    np.add.at(held, (plan.leaf[term], doc), part)
    for first, left, right in plan.levels:
        np.add(held[left], held[right], out=held[first : first + len(left)])
    for parts in plan.parts:
        yield held[parts].sum(axis=0)


class Best:
    """The ``k`` best documents of an item so far, as columns score, null id, id."""

    def __init__(self, k: int):
        self.k, self.rows = k, np.empty((0, 3), dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        at = np.flatnonzero(scores >= (max(1, self.rows[-1, 0]) if len(self.rows) == self.k else 1))
        if len(at) > self.k:
            at = at[scores[at] >= np.partition(scores[at], -self.k)[-self.k]]
        if len(at):
            rows = np.concatenate([self.rows, np.stack([scores[at], nulls[at], ids[at]], axis=1)])
            self.rows = rows[np.lexsort((rows[:, 2], rows[:, 1], -rows[:, 0]))[: self.k]]


def count_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, n`` and, of the terms that are in ``terms``, their numbers and counts."""
    known = docs.sparkSession.sparkContext.broadcast({t.encode(): i for i, t in enumerate(terms)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            n, ids, counts = [], [], []
            for text in batch.column(1):
                words = (text.as_py() or b"").translate(_TERM_BYTES).split()
                n.append(len(words))
                found = [(number[w], c) for w, c in Counter(words).items() if w in number]
                ids.append([t for t, _ in found])
                counts.append([c for _, c in found])
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<int>").where("n > 0")


def best_of_tasks(
    counted: DataFrame, plan: Plan, weight: np.ndarray, n_docs: int, n_terms: int, k: int, id_type: DataType
) -> DataFrame:
    """The ``k`` best of each item among the documents of a task."""
    held = counted.sparkSession.sparkContext.broadcast((plan, weight))
    kinds = {"item_id": to_arrow_type(id_type), "doc_id": pa.int64(), "score": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight = held.value
        best = [Best(k) for _ in plan.items]
        step = max(1, CELLS // max(1, plan.n_nodes))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                ids, n, terms, counts = (batch.column(c) for c in ("doc_id", "n", "terms", "counts"))
                m = 100 - 90 + (90 * n.to_numpy() * n_docs) // n_terms
                doc = terms.value_parent_indices().to_numpy()
                parts = terms.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
                nulls = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                numbers = ids.fill_null(0).to_numpy()
                for own, scores in zip(best, item_scores(plan, weight, doc, *parts, m)):
                    own.add(scores, numbers, nulls)
        rows = [(plan.items[i], None if null else doc, score) for i, b in enumerate(best) for score, null, doc in b.rows.tolist()]
        yield pa.RecordBatch.from_pylist([dict(zip(kinds, row)) for row in rows], pa.schema(kinds))

    return counted.mapInArrow(run, f"item_id {id_type.simpleString()}, doc_id bigint, score bigint")


def item_blocks(items: DataFrame) -> DataFrame:
    """``block, plan``: the items, dealt into blocks, and the plan of each block."""
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    owned = materialize(items.select("item_id", F.explode(F.array_distinct(words)).alias("term")).distinct())
    blocks = max(1, math.ceil(owned.count() / BLOCK_TERMS))

    def mine(rows: pa.Table) -> pa.Table:
        terms_of: dict = {}
        for item, term in zip(rows["item_id"].to_pylist(), rows["term"].to_pylist()):
            terms_of.setdefault(item, []).append(term)
        plan = mined(list(terms_of), list(terms_of.values()))
        return pa.table({"block": rows["block"][:1], "plan": [cloudpickle.dumps(plan)]})

    dealt = owned.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    return materialize(dealt.groupBy("block").applyInArrow(mine, "block bigint, plan binary"))


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``."""
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType
    plans = item_blocks(items)
    found = [spark.createDataFrame([], f"item_id {id_type.simpleString()}, doc_id bigint, score bigint")]
    for row in plans.select("block").orderBy("block").collect():
        plan: Plan = cloudpickle.loads(plans.where(F.col("block") == row.block).first().plan)
        counted = materialize(count_terms(docs, plan.terms))
        n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = np.zeros(len(plan.terms), dtype=np.int64)
        for term, df in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        if n_terms:
            found.append(best_of_tasks(counted, plan, weight, n_docs, n_terms, k, id_type))
    best_first = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best_first))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


SQL = rf"""
with words as (
  select row, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as term
  from (select row_number() over () as row, doc_id, text from documents)),
sizes as (select row, any_value(doc_id) as doc_id, count(*) as n from words group by row),
totals as (select count(*) as n_docs, sum(n)::bigint as n_terms from sizes),
wanted as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as term
  from benchmark),
counts as (
  select row, term, count(*) as tf from words
  where term in (select term from wanted) group by row, term),
weights as (
  select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from counts, totals group by term, n_docs),
scores as (
  select item_id, row,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::bigint as score
  from counts join sizes using (row) join weights using (term) join wanted using (term), totals
  group by item_id, row),
ranked as (
  select item_id, doc_id, score,
    row_number() over (partition by item_id order by score desc, doc_id) as rank
  from scores join sizes using (row) where score > 0)
select item_id, rank::integer as rank, doc_id, score from ranked where rank <= 10
"""

QUERIES = {"op13_shared_search": (op13_shared_search, SQL)}
