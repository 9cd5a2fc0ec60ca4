"""MinHash near-dedup by a chosen-path set similarity join.

Documents are sets of word shingles. Documents with equal sets are one class, told by a
digest of the set; the join works on classes. ``TREES`` independent trees branch the
classes by minwise tokens (the least value of a random order over the set, which two sets
share with a probability equal to their Jaccard similarity):

* At its root a tree sends each class to the node of one minwise token.
* A node of at most ``LEAF`` classes, ``CROWD`` below the roots, is compared exhaustively, on
  sketches of ``TOKENS`` minwise tokens.
* In a larger node most classes may be known to be connected. If at most ``CENTRES`` are
  not of its main component, these are compared with all of the node, which costs in
  proportion to its size. Else the node branches: each class goes to ``CHILDREN`` nodes, by
  ``DEPTH`` other tokens each. So a group of many near copies is never compared all with
  all, and a node of unlike documents falls apart within a few levels.
* A class goes on from its roots only if less than ``ENOUGH`` of them end there, in a node
  that is compared or has one component. So a passage that many documents share is no
  reason to branch them all: they meet their links by other roots.
* Pairs within a component, and nodes of one component alone, are passed over.

To know components early, a first stage takes a few trees, their first level, and two
centres of each large node. The second takes half the trees and of each class the best 8
partners of a node, the last all partners, so what is left at the end is compared without
any limit; each stage sees the components that the one before it has found.

Pairs whose sketches agree in less than ``DOUBT`` of the tokens are dropped: at a true
similarity of 0.8 that is 4 standard deviations away. All others are confirmed on the
full sets, made from the whole texts.

A compared node may be a crowd, whose pairs are many and hardly any a link, as where texts
share a long passage. If there are more than ``CLOSE`` pairs a class, the pairs are not
handed on; the classes' ``FINE`` least hashes are gathered by node instead, which costs in
proportion to the classes, and tell the similarity exactly for sets of at most ``FINE``
shingles. For others a pair is dropped 4 standard deviations below the threshold.

The deeper a class goes, the likelier a link is missed, and the trees of a round share their
tokens. ``missed`` has the probability for a pair of similarity 0.8, ``DOUBT`` included:
0.0014 at 3 levels, 0.013 at 5, 0.12 at 12. So classes that went so deep that it exceeds
``MISS`` get further rounds of ``TREES`` trees, each with tokens of its own made anew from
their texts, until the product is at most ``MISS``. A class that does not go on misses a
link if at least ``ENOUGH`` roots end and the link's other side has none of them. In a tree
that has a probability of 0.2 at most, and not to end there one of 0.8 at most, whatever
the other documents are; ``missed_at_roots`` sums it up to 0.0002, ``DOUBT`` left out.

Nothing is held per group: nodes are counted in each task before the shuffle, centres are
cut in each task, joins on hot nodes are left to adaptive execution. Texts are moved only
for classes with a candidate.

Defined results: A-Z are lower-cased; a text of fewer words than a shingle is one shingle of
all of them; a null text, or one without words, has no shingles and is linked with nothing;
a component's id is its least ``doc_id``, null if none of its rows has one; repeated rows
are in one class; an empty table gives an empty result; other columns than those named are
not returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..scratch import materialize, materialize_counted, scope
from .common import WORD, table
from .components import components
from .tokens import hashed_words, mixed, rolled, slices, starts_of, texts_of

SHINGLE, SIMILARITY = 5, 0.8
TREES, TOKENS, CENTRES, DEPTH, CHILDREN = 16, 128, 64, 3, 2
#: Classes of a node that is compared whole, at a root and further down, where they are much alike.
LEAF, CROWD = 256, 2048
DOUBT = 0.66
#: Pairs for each class of a node from which on the node is a crowd, and hashes of a set that it is compared by.
CLOSE, FINE = 4, 512
#: Share of a class's roots that is enough to find its links by.
ENOUGH = 0.625
#: Probability at most of missing a pair at the threshold, whatever its depth.
MISS = 0.001
#: Levels after which a node that does not fall apart is compared in blocks, whole.
LEVELS = 12
BLOCK = 512
#: Classes whose partners are sought at once.
STRIP = 128
#: Trees, partners of a class that are taken from a node, and whether large nodes branch.
STAGES = ((4, 2, False), (8, 8, True), (TREES, None, True))
#: Ids that are broadcast at most (16 MB); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
FOLD = bytes.maketrans(UPPER, LOWER)


def factors(turn: int) -> np.ndarray:
    """Odd factors, one per minwise order, others in each round."""
    n = TREES + TOKENS
    return mixed(np.arange(turn * n + 1, (turn + 1) * n + 1, dtype=np.uint64)) | np.uint64(1)


def missed(levels: int, similarity: float) -> float:
    """Probability that a round misses a pair whose nodes end after ``levels`` levels."""
    out = 0.0
    for agreed in range(TOKENS + 1):
        share = agreed / TOKENS
        chance = math.comb(TOKENS, agreed) * similarity**agreed * (1 - similarity) ** (TOKENS - agreed)
        together = 1.0
        for _ in range(levels):
            together = 1 - (1 - share**DEPTH * together) ** CHILDREN
        out += chance * ((1 - similarity * together) ** TREES if share >= DOUBT else 1.0)
    return out


def missed_at_roots(similarity: float) -> float:
    """Probability at most of missing a pair of which one side does not go on from its roots."""
    apart, least = 1 - similarity, math.ceil(ENOUGH * TREES)
    return sum(math.comb(TREES, m) * apart**m * similarity ** (TREES - m) for m in range(least, TREES + 1))


def level_of_turn(turn: int, similarity: float) -> int | None:
    """The least level at which ``turn`` rounds miss more than ``MISS``; None if none does."""
    for level in range(1, LEVELS + 1):
        if missed(level, similarity) ** turn > MISS:
            return level
    return None


def shingles(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as hashes, sorted, and each text's end in them."""
    hashes, ends = hashed_words([t.translate(FOLD) for t in texts], xxhash.xxh3_64_intdigest)
    begins = starts_of(ends)
    sizes = ends - begins
    at = np.arange(len(hashes))
    of = np.repeat(np.arange(len(texts)), sizes)
    fits = at + width <= ends[of]
    values, owner = rolled(hashes, at[fits], width, 1), of[fits]
    for words in range(1, width):
        short = np.flatnonzero(sizes == words)
        if len(short):
            values = np.concatenate([values, rolled(hashes, begins[short], words, 100 + words)])
            owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), dtype=bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[first], np.searchsorted(owner[first], np.arange(len(texts)), side="right")


def sketch(values: np.ndarray, begins: np.ndarray, turn: int) -> np.ndarray:
    """The least value of each set in each order; the sets adjoin and are not empty."""
    orders = factors(turn)
    out = np.empty((len(begins), len(orders)), dtype=np.uint64)
    for i, factor in enumerate(orders):
        out[:, i] = np.minimum.reduceat(values * factor, begins)
    return out


def sketches(docs: DataFrame, width: int, turn: int = 0) -> DataFrame:
    """``doc_id, n_shingles, text_key, id, roots, tokens``; the last three null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("_text"))
            for a, b in slices(texts):
                values, ends = shingles(texts[a:b], width)
                begins = starts_of(ends)
                full = np.flatnonzero(ends > begins)
                ids, roots, tokens = ([None] * (b - a) for _ in range(3))
                if len(full):
                    least = sketch(values, begins[full], turn)
                    # 16 bits of a token are enough to compare by.
                    short = (least[:, TREES:] >> np.uint64(40)).astype(np.uint16)
                    for row, i in enumerate(full.tolist()):
                        ids[i] = hashlib.md5(values[begins[i] : ends[i]].tobytes()).digest()
                        roots[i] = least[row, :TREES].view(np.int64).tolist()
                        tokens[i] = short[row].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[a:b],
                        pa.array(ends - begins),
                        batch.column("text_key")[a:b],
                        pa.array(ids, pa.binary()),
                        pa.array(roots, pa.list_(pa.int64())),
                        pa.array(tokens, pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "text_key", "id", "roots", "tokens"],
                )

    given = docs.select("doc_id", F.col("text").cast("binary").alias("_text")).withColumn(
        "text_key", F.unhex(F.md5("_text"))
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(
        run, f"doc_id {kind}, n_shingles long, text_key binary, id binary, roots array<long>, tokens binary"
    )


def token_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), TOKENS)


PAIRS = "a long, b long, agreed double"


def pair_batch(a: np.ndarray, b: np.ndarray, agreed: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(agreed)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "agreed"])


def members_of(rows: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``cid, label, n`` and the tokens of the members of a node."""
    flat = rows.values
    return (*[flat.field(c).to_numpy() for c in ("cid", "label", "n")], token_matrix(flat.field("tokens")))


def likely_pairs(
    x: tuple, y: tuple, similarity: float, top: int | None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each of ``x`` the likely partners in ``y`` of other components, the ``top`` best.

    Places in ``x`` and ``y``, and the share of tokens they agree in. Goes through ``x`` in strips, so that neither a matrix nor a batch has a whole large node.
    """
    (a, la, na, ta), (b, lb, nb, tb) = x, y
    # All pairs of a node: each is counted once.
    once = x is y and top is None
    for begin in range(0, len(a), STRIP):
        rows, others = slice(begin, begin + STRIP), slice(begin if once else 0, None)
        agreed = np.stack([np.count_nonzero(tb[others] == one, axis=1) for one in ta[rows]])
        likely = (agreed >= DOUBT * TOKENS) & (la[rows, None] != lb[None, others])
        likely &= np.minimum.outer(na[rows], nb[others]) >= similarity * np.maximum.outer(na[rows], nb[others]) - 1e-9
        if once:
            likely = np.triu(likely, 1)
        elif top is not None and top < len(b):
            worst = np.argpartition(-np.where(likely, agreed, 0), top, axis=1)[:, top:]
            np.put_along_axis(likely, worst, False, axis=1)
        i, j = np.nonzero(likely)
        yield i + begin, j + (begin if once else 0), agreed[i, j] / TOKENS


def best_partners(x: tuple, y: tuple, similarity: float, top: int | None) -> Iterator[pa.RecordBatch]:
    """The ``likely_pairs`` as rows."""
    for i, j, agreed in likely_pairs(x, y, similarity, top):
        yield pair_batch(x[0][i], y[0][j], agreed)


def pairs_in_leaves(nodes: DataFrame, similarity: float, top: int | None) -> DataFrame:
    """Candidates within the nodes of ``members``; without ``top`` a crowd's ``node`` instead of its pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, rows in zip(batch.column("node").to_pylist(), batch.column("members"), strict=True):
                x = members_of(rows)
                held, n_pairs, most = [], 0, CLOSE * len(x[0])
                for pairs in best_partners(x, x, similarity, top):
                    held.append(pairs)
                    n_pairs += len(pairs)
                    if top is None and n_pairs > most:
                        held = [pa.RecordBatch.from_pylist([{"a": None, "b": None, "agreed": None}], pairs.schema)]
                        break
                for pairs in held:
                    of = pa.array([node if top is None and n_pairs > most else None] * len(pairs), pa.int64())
                    yield pairs.append_column("node", of)

    return nodes.select("node", "members").mapInArrow(run, f"{PAIRS}, node long").distinct()


class LeastHashes:
    """The least hashes of some sets, each ascending; ``whole`` sets have all of theirs."""

    def __init__(self, fine: list[bytes], whole: np.ndarray):
        distinct, self.values = np.unique(np.frombuffer(b"".join(fine), dtype=np.uint32), return_inverse=True)
        self.ends = np.cumsum([len(f) // 4 for f in fine])
        self.begins = starts_of(self.ends)
        self.last = np.where(whole, len(distinct), self.values[self.ends - 1])
        self.marks = np.zeros(len(distinct), dtype=bool)

    def near(self, i: int, js: np.ndarray) -> np.ndarray:
        """Similarity of the set ``i`` with those of ``js``.

        What two have up to the lesser of their last ones is a sample of their union that has
        ``FINE`` hashes at least, or is the union.
        """
        own = self.values[self.begins[i] : self.ends[i]]
        self.marks[own] = True
        common = np.add.reduceat(self.marks[self.values], self.begins, dtype=np.int64)[js]
        self.marks[own] = False
        theirs = np.add.reduceat(self.values <= self.last[i], self.begins, dtype=np.int64)[js]
        return common / (theirs + np.searchsorted(own, self.last[js], side="right") - common)


def pairs_in_crowds(nodes: DataFrame, similarity: float) -> DataFrame:
    """Candidates within crowds, whose members have their ``fine`` hashes."""
    doubt = similarity - 4 * math.sqrt(similarity * (1 - similarity) / FINE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in batch.column("members"):
                x = members_of(rows)
                whole = x[2] <= FINE
                hashes = LeastHashes(rows.values.field("fine").to_pylist(), whole)
                for i, j, agreed in likely_pairs(x, x, similarity, None):
                    near = np.zeros(len(i))
                    for one in np.unique(i):
                        at = np.flatnonzero(i == one)
                        near[at] = hashes.near(one, j[at])
                    # Room for hashes of 32 bits that are equal by chance.
                    keep = near >= np.where(whole[i] & whole[j], similarity - 0.01, doubt)
                    yield pair_batch(x[0][i[keep]], x[0][j[keep]], agreed[keep])

    return nodes.select("members").mapInArrow(run, PAIRS).distinct()


def pairs_with_centres(blocks: DataFrame, similarity: float, top: int | None) -> DataFrame:
    """Candidates between the ``centres`` of a node and a block of its ``members``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for centres, rows in zip(batch.column("centres"), batch.column("members"), strict=True):
                c, x = members_of(centres), members_of(rows)
                # Few centres: the members choose among them; many members: the centres choose.
                yield from best_partners(c, x, similarity, top) if top != 2 else best_partners(x, c, similarity, top)

    return blocks.select("centres", "members").mapInArrow(run, PAIRS)


def gathered(rows: DataFrame, facts: DataFrame, size: int, name: str) -> DataFrame:
    """``node`` and ``name``, an array of at most about ``size`` of its rows with their facts.

    ``rows`` has ``node, cid, label``, and ``members``, the number of rows of the node.
    """
    part = F.pmod(F.xxhash64("cid"), F.ceil(F.col("members") / size))
    dealt = rows.withColumn("part", part).join(facts, "cid")
    member = F.struct("cid", "label", *[c for c in facts.columns if c != "cid"])
    return dealt.groupBy("node", "part").agg(F.collect_list(member).alias(name)).drop("part")


def children(rows: DataFrame) -> DataFrame:
    """The classes of nodes that branch, each in ``CHILDREN`` nodes by ``DEPTH`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = token_matrix(batch.column("tokens")).astype(np.uint64)
            node = batch.column("node").to_numpy().view(np.uint64)
            line = np.arange(len(batch))
            for child in range(CHILDREN):
                key = mixed(node + np.uint64(child + 1))
                new = key
                for k in range(DEPTH):
                    which = (mixed(key + np.uint64(k + 7)) % np.uint64(TOKENS)).astype(np.int64)
                    new = mixed(new ^ (tokens[line, which] + (which.astype(np.uint64) << np.uint64(20))))
                columns = [pa.array(new.view(np.int64)), batch.column("cid"), batch.column("label")]
                yield pa.RecordBatch.from_arrays(columns, ["node", "cid", "label"])

    return rows.select("node", "cid", "label", "tokens").mapInArrow(run, "node long, cid long, label long")


def candidates(
    classes: DataFrame,
    labels: DataFrame | None,
    trees: int,
    top: int | None,
    branch: bool,
    similarity: float,
    fine: Callable[[DataFrame], DataFrame],
) -> tuple[DataFrame, list[DataFrame]]:
    """Pairs ``a, b`` of classes of different components, with the share of tokens they agree in.

    Also the rows of each level, the roots' left out. ``fine`` has the least hashes of classes.
    """
    facts = classes.select("cid", "n", "tokens")
    roots = F.slice("roots", F.lit(1), F.lit(trees))
    rows = classes.select("cid", F.posexplode(roots).alias("tree", "token")).select(
        F.xxhash64("tree", "token").alias("node"), "cid"
    )
    if labels is None:
        rows = rows.withColumn("label", F.col("cid"))
    else:
        rows = rows.join(labels, "cid", "left").select("node", "cid", F.coalesce("label", "cid").alias("label"))
    found, levels, level = [], [], 0
    while True:
        whole = CROWD if level else LEAF
        sizes = materialize(
            rows.groupBy("node")
            .agg(F.count(F.lit(1)).alias("members"), F.min("label").alias("lo"), F.max("label").alias("hi"))
            .where("lo <> hi")
            .select("node", "members")
        )
        small = rows.join(sizes.where(F.col("members") <= whole), "node")
        pairs = materialize(pairs_in_leaves(gathered(small, facts, whole + 1, "members"), similarity, top))
        found.append(pairs.where("node is null").drop("node"))
        if top is None:
            crowds, n_crowds = materialize_counted(pairs.where("node is not null").select("node"))
            if n_crowds:
                small = materialize(small.join(crowds, "node"))
                hashes = facts.join(fine(small.select("cid").distinct()), "cid")
                found.append(materialize(pairs_in_crowds(gathered(small, hashes, whole + 1, "members"), similarity)))
        large, n_large = materialize_counted(rows.join(sizes.where(F.col("members") > whole), "node"))
        if not n_large:
            break
        if branch:
            main = F.max_by("label", F.struct("k", "label")).alias("main")
            odd = (F.sum("k") - F.max("k")).alias("odd")
            shape = large.groupBy("node", "label").agg(F.count(F.lit(1)).alias("k"))
            shape = materialize(shape.groupBy("node").agg(main, odd))
            ends = F.lit(level >= LEVELS) | (F.col("odd") <= CENTRES)
            last = large.join(shape.where(ends), "node")
            chosen = last.where("label <> main").drop("members").withColumnRenamed("odd", "members")
        else:
            by_chance = Window.partitionBy("node").orderBy(F.xxhash64("cid"), "cid")
            last = large
            chosen = large.withColumn("_rn", F.row_number().over(by_chance)).where("_rn <= 2")
            chosen = chosen.withColumn("members", F.lit(2))
        centres = gathered(chosen, facts, CENTRES, "centres")
        blocks = gathered(last, facts, BLOCK, "members").join(centres, "node")
        found.append(materialize(pairs_with_centres(blocks, similarity, top)))
        if not branch:
            break
        onward = large.join(shape.where(~ends), "node")
        if level == 0:
            ended = trees - F.count(F.lit(1))
            onward = onward.join(onward.groupBy("cid").agg(ended.alias("ended")).where(F.col("ended") < ENOUGH * trees), "cid")
        rows, n_rows = materialize_counted(children(onward.join(facts.select("cid", "tokens"), "cid")))
        if not n_rows:
            break
        levels.append(rows.select("cid"))
        level += 1
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.groupBy("a", "b").agg(F.max("agreed").alias("agreed")), levels


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs whose sets, made from the whole texts, are similar enough."""
    percent = round(100 * similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = texts_of(batch.column("text_a")), texts_of(batch.column("text_b"))
            keep = np.zeros(len(batch), dtype=bool)
            for i in range(0, len(batch), 64):
                some = ta[i : i + 64] + tb[i : i + 64]
                values, ends = shingles(some, width)
                sets = np.split(values, ends[:-1])
                half = len(some) // 2
                for k in range(half):
                    x, y = sets[k], sets[half + k]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    keep[i + k] = common > 0 and 100 * common >= percent * (len(x) + len(y) - common)
            rows = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(rows) for c in "ab"], ["a", "b"])

    first, second = (texts.select(F.col("cid").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    return pairs.select("a", "b").join(first, "a").join(second, "b").mapInArrow(run, "a long, b long")


def relabelled(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The pairs that join different components, with ``la, lb``, the components' labels."""
    if labels is None:
        return pairs.withColumn("la", F.col("a")).withColumn("lb", F.col("b"))
    out = pairs
    for c in "ab":
        names = labels.select(F.col("cid").alias(c), F.col("label").alias(f"_{c}"))
        out = out.join(names, c, "left").withColumn(f"l{c}", F.coalesce(f"_{c}", c)).drop(f"_{c}")
    return out.where("la <> lb")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The labels after new links."""
    if labels is None:
        return components(links).withColumnRenamed("id", "cid")
    moves = components(relabelled(links, labels).select(F.col("la").alias("a"), F.col("lb").alias("b")))
    ends = links.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    known = labels.unionByName(ends.join(labels, "cid", "left_anti").select("cid", F.col("cid").alias("label")))
    moves = moves.select(F.col("id").alias("label"), F.col("label").alias("to"))
    return materialize(known.join(moves, "label", "left").select("cid", F.coalesce("to", "label").alias("label")))


def rows_of_classes(docs: DataFrame, classes: DataFrame, cids: DataFrame) -> DataFrame:
    """``cid, text`` of the rows that have the texts of the classes ``cids``."""
    ids, n_ids = materialize_counted(cids.join(classes.select("cid", "text_key"), "cid"))
    wanted = F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids
    text = F.col("text").cast("binary")
    rows = docs.select(text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))
    return rows.join(wanted, "text_key").select("cid", "text")


def texts_of_classes(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``cid, text`` of the classes in ``pairs``."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    return materialize(rows_of_classes(docs, classes, ends).groupBy("cid").agg(F.first("text").alias("text")))


def fine_hashes(docs: DataFrame, classes: DataFrame, width: int, cids: DataFrame) -> DataFrame:
    """``cid, fine``: the ``FINE`` least hashes of each class's set in one more order, ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in slices(texts):
                values, ends = shingles(texts[a:b], width)
                short = (mixed(values) >> np.uint64(32)).astype(np.uint32)
                sets = np.split(short, ends[:-1])
                fine = [np.sort(np.partition(x, FINE - 1)[:FINE] if len(x) > FINE else x).tobytes() for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column("cid")[a:b], pa.array(fine, pa.binary())], ["cid", "fine"])

    rows = rows_of_classes(docs, classes, cids).mapInArrow(run, "cid long, fine binary")
    return materialize(rows.groupBy("cid").agg(F.first("fine").alias("fine")))


def sketched_anew(docs: DataFrame, classes: DataFrame, cids: DataFrame, width: int, turn: int) -> DataFrame:
    """The ``classes`` in ``cids`` with roots and tokens of their own for this round."""
    wanted, n = materialize_counted(classes.join(cids, "cid", "left_semi").select("cid", "n", "text_key"))
    text = F.col("text").cast("binary")
    keys = wanted.select("text_key")
    rows = docs.withColumn("text_key", F.unhex(F.md5(text))).join(
        F.broadcast(keys) if n <= BROADCAST_IDS else keys, "text_key", "left_semi"
    )
    fresh = sketches(rows, width, turn).groupBy("text_key")
    fresh = fresh.agg(F.first("roots").alias("roots"), F.first("tokens").alias("tokens"))
    return materialize(wanted.join(fresh, "text_key"))


def linked_classes(docs: DataFrame, classes: DataFrame, width: int, similarity: float) -> DataFrame | None:
    """``cid, label`` of the classes that have a link; None if none has."""
    labels, tried = None, None

    def link(some: DataFrame, trees: int, top: int | None, branch: bool) -> list[DataFrame]:
        with scope(docs.sparkSession) as keep:
            levels = link_by(some, trees, top, branch)
            keep(labels, tried, *levels)
        return levels

    def link_by(some: DataFrame, trees: int, top: int | None, branch: bool) -> list[DataFrame]:
        nonlocal labels, tried
        pairs, levels = candidates(some, labels, trees, top, branch, similarity, partial(fine_hashes, docs, classes, width))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs, n_pairs = materialize_counted(pairs)
        if n_pairs:
            texts = texts_of_classes(docs, classes, pairs)
            tried = pairs.select("a", "b") if tried is None else tried.unionByName(pairs.select("a", "b"))
            links, n_links = materialize_counted(confirmed(pairs, texts, width, similarity))
            labels = merged(labels, links) if n_links else labels
        return levels

    for trees, top, branch in STAGES:
        levels = link(classes, trees, top, branch)
    # The levels of the last stage, which has all trees and partners, and of the rounds after it.
    rounds = [levels]
    while (level := level_of_turn(len(rounds), similarity)) is not None:
        deep = [levels[level - 1] for levels in rounds if len(levels) >= level]
        if not deep:
            break
        cids = deep[0]
        for more in deep[1:]:
            cids = cids.unionByName(more)
        fresh = sketched_anew(docs, classes, cids.distinct(), width, len(rounds))
        rounds.append(link(fresh, TREES, None, True))
    return labels


def near_duplicates(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, text_key, id, label, component_id`` of each document.

    ``text_key`` is the digest of its text, ``id`` tells its set, ``label`` its component.
    """
    with scope(docs.sparkSession) as keep:
        rows = materialize(sketches(docs, width))
        classes = materialize(
            rows.where("id is not null")
            .groupBy("id")
            .agg(
                F.min("doc_id").alias("doc_id"),
                F.first("n_shingles").alias("n"),
                F.min("text_key").alias("text_key"),
                F.first("roots").alias("roots"),
                F.first("tokens").alias("tokens"),
            )
            # Written down with the class, so it stays what it is.
            .withColumn("cid", F.monotonically_increasing_id())
        )
        labels = linked_classes(docs, classes, width, similarity)
        named = classes.select("id", "doc_id", "cid")
        if labels is None:
            named = named.withColumn("label", F.col("cid"))
        else:
            named = named.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
        least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        groups = materialize(named.join(least, "label").select("id", "label", "component_id"))
        keep(rows, groups)
    return (
        rows.select("doc_id", "n_shingles", "text_key", "id")
        .join(groups, "id", "left")
        .withColumn("component_id", F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    )


def row_key(text_key: Column) -> Column:
    return F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.lit("/"), F.hex(text_key))


def one_of_each(docs: DataFrame, width: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each component, the one of the least id.

    Documents without words stay. The texts are moved once, to meet the chosen rows.
    """
    with scope(docs.sparkSession) as keep:
        found = near_duplicates(docs, width, similarity).where("id is not null")
        least = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))).alias("_one")
        ones = found.groupBy("label").agg(least).select("_one.*")
        chosen = materialize(ones.select(row_key(F.col("text_key")).alias("_row")))
        keep(chosen)
    keyed = docs.withColumn("_row", row_key(F.unhex(F.md5(F.col("text").cast("binary")))))
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    kept = keyed.where(has_words).join(chosen, "_row", "left_semi").dropDuplicates(["_row"])
    return kept.drop("_row").unionByName(docs.where(~has_words))


def op7_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, width=4)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


QUERIES = {"op7_chosen_path": (op7_chosen_path, None)}
