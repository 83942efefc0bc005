"""Hard negatives through a multiway hyperplane tree with sibling ranges.

Rows become integer vectors and are put on one sphere by a last coordinate sqrt(M - |x|^2), where M
is the largest squared norm, so that the distance from an anchor (last coordinate 0) falls as the
inner product grows: a window of scores is an annulus around the anchor. Each node of the tree has up
to FAN split points; a row goes to the nearest, and the node keeps for every split point the range
of its distances to the rows of every subtree. A subtree whose range misses, for any split point,
what the triangle inequality leaves of the annulus, is eliminated. Leaves that remain are searched
exactly, so results do not depend on the tree.

The tree is fitted on at most SAMPLE rows; all rows are indexed, and ranges come from all rows. The
sample also gives every search its first bound: the scores of rows that are known to qualify.
Leaves are cut into chunks of CHUNK rows and anchors into blocks of BLOCK, so a task holds one chunk
and one block, also where one vector is very common.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayspan.llm.textops import store

SAMPLE = 4096
SAMPLE_BYTES = 32 << 20  # fewer rows where vectors are very long
FAN = 16
DEPTH = 4
LEAF = 256  # rows for which a leaf is not split
CHUNK = 8192
BLOCK = 8192
CELLS = 1 << 22  # scores held at once
FOUND = "anchor long, slot int, row long, id long, score long"


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of two sets of integral vectors, at most 64 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(a) @ whole(b).T if a.size and b.size else np.zeros((len(a), len(b)), object)
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(zero_copy_only=False)
    return out


@dataclass
class Node:
    points: np.ndarray  # split points, as numbers in the sample
    children: list[int] = field(default_factory=list)  # a node, or the complement of a leaf
    low: np.ndarray | None = None  # [split point, child]
    high: np.ndarray | None = None


class Tree:
    """The tree over a sample of rows; ``largest`` is the squared radius of the sphere."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, largest: float, total: int):
        self.rows, self.ids, self.labels, self.vectors, self.largest = rows, ids, labels, vectors, largest
        self.lift = self._lift(vectors)
        self.slack = 1e-6 * (largest**0.5) + 1e-6
        self.nodes, self.leaves, self.share = [], 0, total / max(1, len(rows))
        self.root = self._grow(np.arange(len(rows)), 0)

    def _lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.largest - (x * x).sum(1), 0))

    def between(self, x: np.ndarray, points: np.ndarray, lift: np.ndarray | None = None) -> np.ndarray:
        """Distances from lifted rows to split points; ``lift`` is the rows' last coordinate."""
        lift = self._lift(x) if lift is None else lift
        length = (x * x).sum(1) + lift * lift
        inner = x @ self.vectors[points].T + np.outer(lift, self.lift[points])
        own = (self.vectors[points] ** 2).sum(1) + self.lift[points] ** 2
        return np.sqrt(np.maximum(length[:, None] + own - 2 * inner, 0))

    def _grow(self, members: np.ndarray, depth: int) -> int:
        points = self._spread(members) if depth < DEPTH and len(members) * self.share > LEAF and len(members) > 2 * FAN else members[:0]
        if len(points) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        number, node = len(self.nodes), Node(points)
        self.nodes.append(node)
        near = self.between(self.vectors[members], points).argmin(1)
        node.children = [self._grow(members[near == k], depth + 1) for k in range(len(points))]
        node.low, node.high = np.full((len(points),) * 2, np.inf), np.full((len(points),) * 2, -np.inf)
        return number

    def _spread(self, members: np.ndarray) -> np.ndarray:
        """Up to FAN members, each as far as possible from those before; equal vectors count once."""
        chosen = [members[0]]
        far = self.between(self.vectors[members], members[:1])[:, 0]
        while len(chosen) < FAN and far.max() > self.slack:
            chosen.append(members[int(far.argmax())])
            far = np.minimum(far, self.between(self.vectors[members], np.array(chosen[-1:]))[:, 0])
        return np.array(chosen)

    def walk(self, x: np.ndarray, leaf: np.ndarray) -> Iterator[tuple]:
        """Send rows down, filling in ``leaf``: (node, rows, distances to its split points, child)."""
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            number, at = todo.pop()
            if number < 0:
                leaf[at] = ~number
            elif len(at):
                node = self.nodes[number]
                away = self.between(x[at], node.points)
                near = away.argmin(1)
                yield number, at, away, near
                todo += [(child, at[near == k]) for k, child in enumerate(node.children)]

    def reached(self, x: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """[anchor, leaf]: the leaves that may hold rows with ``least`` <= score <= ``most``."""
        out = np.zeros((len(x), self.leaves), bool)
        length = (x * x).sum(1) + self.largest
        distance = lambda score: np.sqrt(np.maximum(length - 2 * score, 0))
        inner, outer = distance(most) - self.slack, distance(least) + self.slack
        todo = [(self.root, np.flatnonzero((least <= most) & (length - 2 * least >= -self.slack)))]
        while todo:
            number, at = todo.pop()
            if number < 0:
                out[at, ~number] = True
            elif len(at):
                node = self.nodes[number]
                away = self.between(x[at], node.points, np.zeros(len(at)))
                far = away + outer[at, None]
                near = np.maximum(away - outer[at, None], inner[at, None] - away)
                for k, child in enumerate(node.children):
                    todo.append((child, at[((node.low[:, k] <= far) & (node.high[:, k] >= near)).all(1)]))
        return out


def _first(values: np.ndarray, allowed: np.ndarray, top: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of the matrix, column) of the first ``top`` allowed entries of each row, largest first and
    leftmost on ties."""
    rest = np.where(allowed, values, np.iinfo(np.int64).min)
    allowed = allowed.copy()
    for _ in range(min(top, values.shape[1])):
        best = rest.argmax(1)
        rows = np.flatnonzero(allowed[np.arange(len(best)), best])
        if not len(rows):
            return
        yield rows, best[rows]
        rest[rows, best[rows]], allowed[rows, best[rows]] = np.iinfo(np.int64).min, False


def _by_id(table: pa.Table) -> pa.Table:
    """By id, null last, so that the leftmost of equal scores is the smallest id."""
    return table.sort_by([("id", "ascending"), ("row", "ascending")]) if table.num_rows else table


def _bounds(sample_scores: np.ndarray, allowed: np.ndarray, top: int) -> np.ndarray:
    """The ``top``-th largest allowed score of each row, the smallest number where there are fewer."""
    lowest = np.iinfo(np.int64).min
    if sample_scores.shape[1] < top:
        return np.full(len(sample_scores), lowest)
    return np.partition(np.where(allowed, sample_scores, lowest), -top, axis=1)[:, -top]


def _windows(table, share: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor number, lowest score, highest score) of every positive of the anchors: the scores s
    with low * p <= high * s <= high * p."""
    lists = table["positives"].combine_chunks() if isinstance(table["positives"], pa.ChunkedArray) else table["positives"]
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    top = lists.flatten().field("score").to_numpy()
    low = np.array([-((-share[0] * int(p)) // share[1]) for p in top], np.int64)
    return owner, low, top


def _reach(tree, dims: int, top: int, share: tuple[int, int] | None):
    """Anchors (row, label, vector, positives) to the leaves that they have to search, by the bounds
    that the sample gives; without ``share`` for positives, else for negatives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tree.value
        for batch in batches:
            windows = 1 if share is None else max(map(len, batch["positives"]), default=1)
            step = max(1, CELLS // max(1, len(t.rows) * windows))
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                x, row, label = matrix(part["vector"], dims), part["row"].to_numpy(), part["label"].to_numpy()
                known, same = scores(x, t.vectors), label[:, None] == t.labels
                if share is None:
                    least = _bounds(known, same & (row[:, None] != t.rows), top)
                    reached = t.reached(x, least.astype(float), np.full(len(x), np.inf))
                else:
                    reached = np.zeros((len(x), t.leaves), bool)
                    owner, low, high = _windows(part, share)
                    least = np.maximum(low, _bounds(known[owner], ~same[owner] & (known[owner] >= low[:, None]) & (known[owner] <= high[:, None]), top))
                    np.logical_or.at(reached, owner, t.reached(x[owner], least.astype(float), high.astype(float)))
                at, leaf = np.nonzero(reached)
                few = max(1, CELLS // max(1, dims))  # rows whose vectors are written at once
                for first in range(0, len(at), few):
                    take = pa.array(at[first : first + few])
                    yield pa.record_batch([pa.array(leaf[first : first + few], pa.int32()), *[part[c].take(take) for c in part.schema.names]], names=["leaf", *part.schema.names])

    return read


def _search(dims: int, top: int, share: tuple[int, int] | None):
    """One chunk of rows and one block of anchors to the first ``top`` of the chunk for each anchor
    (positives: other rows of its label) or each of its windows (negatives: rows of other labels)."""

    def find(held: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"anchor": [], "slot": [], "at": [], "score": []}
        held, asked = _by_id(held), asked.combine_chunks()
        if held.num_rows and asked.num_rows:
            rows, labels, vectors = held["row"].to_numpy(), held["label"].to_numpy(), matrix(held["vector"], dims)
            step = max(1, CELLS // len(rows))
            for lo in range(0, asked.num_rows, step):
                part = asked.slice(lo, step).combine_chunks()
                row, label = part["row"].to_numpy(), part["label"].to_numpy()
                value = scores(matrix(part["vector"], dims), vectors)
                same = label[:, None] == labels
                if share is None:
                    jobs = [(np.arange(len(row)), np.zeros(len(row), np.int64), same & (row[:, None] != rows))]
                else:
                    owner, low, high = _windows(part, share)
                    slot = np.arange(len(owner)) - np.searchsorted(owner, owner)
                    jobs = []
                    for k in np.unique(slot):
                        w = np.flatnonzero(slot == k)
                        mine = value[owner[w]]
                        jobs.append((owner[w], slot[w], ~same[owner[w]] & (mine >= low[w, None]) & (mine <= high[w, None])))
                for owners, slots, allowed in jobs:
                    mine = value[owners]
                    for line, column in _first(mine, allowed, top):
                        out["anchor"].append(row[owners[line]])
                        out["slot"].append(slots[line])
                        out["at"].append(column)
                        out["score"].append(mine[line, column])
        whole = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
        at = pa.array(whole["at"])
        return pa.table([pa.array(whole["anchor"]), pa.array(whole["slot"], pa.int32()), held["row"].take(at), held["id"].take(at), pa.array(whole["score"])], names=["anchor", "slot", "row", "id", "score"])

    return find


def prepare(rows: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column, scale: int) -> DataFrame:
    """(row, id, label, anchor, vector, norm) of the rows that take part: components are floor(scale x)."""
    sound = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    used = rows.filter(F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & sound)
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    plain = used.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), whole.alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda n, x: n + x * x)
    return store(plain.select(F.monotonically_increasing_id().alias("row"), "*", norm.alias("norm")), "vectors")


def fit(rows: DataFrame) -> tuple[Tree, int]:
    """The tree over a sample of the prepared rows, without ranges, and the longest vector."""
    total, dims, largest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0)), F.coalesce(F.max("norm"), F.lit(0.0))).first()
    size = max(FAN, min(SAMPLE, SAMPLE_BYTES // (8 * max(1, dims))))
    sample = rows.orderBy(F.xxhash64("row")).limit(size).select("row", "id", "label", "vector").toArrow()
    tree = Tree(sample["row"].to_numpy(), sample["id"].to_pandas().to_numpy(), sample["label"].to_numpy(), matrix(sample["vector"], dims), largest, total)
    return tree, dims


def _place(tree, dims: int, ranges: bool):
    """Rows to rows with their leaf; or to the ranges (node, point, child, low, high) of the rows of a task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tree.value
        low = {n: np.full_like(node.low, np.inf) for n, node in enumerate(t.nodes)}
        high = {n: np.full_like(node.high, -np.inf) for n, node in enumerate(t.nodes)}
        for batch in batches:
            x = matrix(batch["vector"], dims)
            leaf = np.zeros(len(x), np.int64)
            for n, _, away, near in t.walk(x, leaf):
                for k in np.unique(near):
                    low[n][:, k] = np.minimum(low[n][:, k], away[near == k].min(0))
                    high[n][:, k] = np.maximum(high[n][:, k], away[near == k].max(0))
            if not ranges:
                yield pa.record_batch([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])
        if ranges:
            for n in low:
                point, child = np.nonzero(low[n] < np.inf)
                yield pa.record_batch([pa.array(np.full(len(point), n)), pa.array(point), pa.array(child), pa.array(low[n][point, child]), pa.array(high[n][point, child])], names=["node", "point", "child", "low", "high"])

    return read


def index(rows: DataFrame) -> tuple[DataFrame, Column, Tree, int]:
    """Prepared rows with leaf and chunk, the number of chunks of a leaf, the tree with the ranges of all rows, and
    the longest vector."""
    tree, dims = fit(rows)
    shared = rows.sparkSession.sparkContext.broadcast(tree)
    found = rows.select("vector").mapInArrow(_place(shared, dims, True), "node long, point long, child long, low double, high double")
    for r in found.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():  # nodes times FAN squared at most
        tree.nodes[r["node"]].low[r["point"], r["child"]], tree.nodes[r["node"]].high[r["point"], r["child"]] = r["low"], r["high"]
    placed = store(rows.mapInArrow(_place(shared, dims, False), _ddl(rows) + ", leaf int"), "leaves")
    sizes = placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()  # one row a leaf
    chunks = F.get(F.array(*[F.lit(n) for n in _chunk_counts(sizes, tree.leaves)]), F.col("leaf"))
    return placed.withColumn("chunk", F.pmod(F.xxhash64("row"), chunks)), chunks, tree, dims


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _chunk_counts(sizes: list, leaves: int) -> list[int]:
    out = [1] * leaves
    for r in sizes:
        out[r["leaf"]] = r["n"] // CHUNK + 1
    return out


def _matches(placed: DataFrame, chunks: Column, anchors: DataFrame, tree, dims: int, top: int, share: tuple[int, int] | None, blocks: int) -> DataFrame:
    """The first ``top`` matches of each anchor (and window): anchor, slot, id, score, place.

    A file of repeated vectors can be a hundredth of its rows' size, and Spark broadcasts by the file's: so no
    join may choose a side with vectors. What is broadcast is one row a leaf with the blocks that reach it.
    """
    asked = anchors.mapInArrow(_reach(tree, dims, top, share), "leaf int, " + _ddl(anchors)).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    asked = store(asked, "asked")
    due = asked.select("leaf", "block").distinct().groupBy("leaf").agg(F.collect_list("block").alias("blocks"))
    held = placed.select("leaf", "chunk", "row", "id", "label", "vector").join(F.broadcast(due), "leaf")
    held = held.select("*", F.explode("blocks").alias("block")).drop("blocks")
    to = {k: f"to_{k}" for k in ("leaf", "chunk", "block")}
    sent = asked.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks.cast("long") - 1))).withColumnsRenamed(to)
    found = held.groupBy(*to).cogroup(sent.groupBy(*to.values())).applyInArrow(_search(dims, top, share), FOUND)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return store(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= top), "matches")


def mine(
    rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100), scale: int = 256,
) -> DataFrame:
    """For each row with ``anchor`` and each of its positives (the first rows of its label, itself left
    out) the first rows of other labels whose score lies between ``share`` of the positive's score
    and all of it: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(scale x), held to 64 bits; higher come first, ties go
    by id, null ids last. Rows with a null label or vector, or a null or non-finite component, take
    no part; shorter vectors count as filled up with zeros. Repeated rows are rows of their own. A
    positive whose window is empty gives no rows, nor does an empty table. Other columns are not
    touched.
    """
    placed, chunks, tree, dims = index(prepare(rows, id_col, vector_col, label_col, anchor, scale))
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(tree)
    anchors = store(placed.filter("anchor").select("row", "id", "label", "vector"), "anchors")
    blocks = anchors.count() // BLOCK + 1
    close = _matches(placed, chunks, anchors, shared, dims, positives, None, blocks)
    lists = close.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))  # at most ``positives`` entries
    wanted = store(anchors.hint("merge").join(lists, F.col("row") == F.col("anchor")).drop("anchor"), "positives")
    far = _matches(placed, chunks, wanted, shared, dims, negatives, share, blocks)
    named = wanted.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode("positives").alias("slot", "p"))
    return far.hint("merge").join(named, ["anchor", "slot"]).select(
        "anchor_id", F.col("p.id").alias("positive_id"), F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"),
    )


def oracle() -> str:
    """DuckDB text of the contract's query."""
    return """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score QUALIFY rank <= 5"""
