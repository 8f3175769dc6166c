"""Near-duplicate vectors by NN-descent.

Equal vectors become one node with a count. A first neighbour graph comes from sorting nodes by
random hyperplane signs, several times, and comparing within runs of the sorted order, so that
dense spots fill several runs instead of one bucket. Each round then compares the neighbours of
a node with each other (lists and reverse lists) and keeps the best. A node that has as many
links as one comparison gives may lack some: it is compared with every node, block by block, and what
that finds counts for both ends and joins components, so the lists' cap loses no link. The
recall is audited on two bounded samples of nodes against all nodes: of nodes that have links,
and of those without whose nearest known neighbour is nearest. While either shows less than
``least_recall``, of links or of links within one component, another round with new hyperplanes
runs; after ``most_rounds`` every node is compared with every node, which is exact. Edges at or
above the threshold give counts and components.

Vectors are kept in the width of their column and compared in double precision, scaled by their
largest component first, so that very small and very large ones have their cosine too.

Edge cases: vectors that are null, zero or hold null or non-finite components link with nothing
and stand alone; vectors of different dimension do not link; equal vectors, repeated rows
included, link with each other; rows without vec_id stand alone with null component_id and
kept false; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ann import usable
from .common import components, cut

LIST, TABLES, RUN, EMIT, MORE_TABLES, BLOCK, AUDIT, SEED = 12, 10, 128, 5, 6, 2048, 256, 11
EDGE = "u long, v long, cos double"
WIDTH = {"array<float>": "<f4", "array<double>": "<f8"}  # stored as the column has them


def unit(blobs: list[bytes], width: str) -> np.ndarray:
    """Vectors of length 1, in double precision."""
    x = np.frombuffer(b"".join(blobs), width).reshape(len(blobs), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def nodes(rows: DataFrame, width: str) -> DataFrame:
    """(id, n, dim, v): distinct usable vectors, as bytes, with their smallest vec_id and count."""
    found = rows.where(usable("embedding") & F.col("vec_id").isNotNull()).groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2)
            v = [np.asarray(row, width).tobytes() for row in x.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), x.value_lengths(), pa.array(v, pa.binary())], ["id", "n", "dim", "v"])

    return found.select("id", "n", "embedding").mapInArrow(run, "id long, n long, dim int, v binary")


def edges_of(ids: np.ndarray, x: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's ``most`` nearest other rows: (u, v, cosine)."""
    s = x @ x.T
    s[ids[:, None] == ids] = -2
    take = min(most, len(ids) - 1)
    near = np.argpartition(-s, take - 1, axis=1)[:, :take]
    cos = np.take_along_axis(s, near, axis=1).ravel()
    ok = cos > -2
    return np.repeat(ids, take)[ok], ids[near].ravel()[ok], cos[ok]


def batch_of(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v, c = (np.concatenate(p) for p in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(c)], ["u", "v", "cos"])


def sorted_runs(v: DataFrame, width: str, tables: int, seed: int) -> DataFrame:
    """Edges between nodes that stand near each other in orders by hyperplane signs."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, blobs = b.column(1).to_numpy(), b.column(2).to_pylist()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = unit([blobs[i] for i in at], width)
                for t in range(tables):
                    planes = np.random.default_rng([seed, t, int(d)]).standard_normal((int(d), 62))
                    codes = ((x @ planes > 0) @ (1 << np.arange(62, dtype=np.int64)[::-1])).astype(np.int64)
                    n = len(at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, d, np.int32)), pa.array(np.full(n, t, np.int32)), pa.array(codes), b.column(0).take(pa.array(at)), b.column(2).take(pa.array(at))], ["dim", "t", "code", "id", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, blobs = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            if len(ids) > 1:
                yield batch_of([edges_of(np.array(ids), unit(blobs, width), EMIT)])

        for b in batches:
            for d, t, i, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                if (d, t) != key or len(ids) == RUN:
                    yield from done()
                    key, ids, blobs = (d, t), [], []
                ids.append(i)
                blobs.append(blob)
        yield from done()

    coded = v.select("id", "dim", "v").mapInArrow(code, "dim int, t int, code long, id long, v binary")
    order = ["dim", "t", "code", F.xxhash64("id")]
    return coded.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compare, EDGE)


def shortened(edges: DataFrame, by: str, most: int) -> DataFrame:
    best = Window.partitionBy(by).orderBy(F.col("cos").desc(), "u", "v")
    return edges.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= most).drop("_r")


def merged(edges: DataFrame) -> DataFrame:
    """Each node's list: its LIST nearest known neighbours."""
    return shortened(edges.groupBy("u", "v").agg(F.max("cos").alias("cos")), "u", LIST)


def descend(v: DataFrame, width: str, graph: DataFrame) -> DataFrame:
    """Edges found among each node's neighbours and reverse neighbours."""
    back = shortened(graph, "v", LIST).select(F.col("v").alias("w"), F.col("u").alias("id"))
    seat = graph.select(F.col("u").alias("w"), F.col("v").alias("id")).unionByName(back).unionByName(v.select(F.col("id").alias("w"), "id")).distinct()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, ids, blobs, parts = None, [], [], []
        for b in batches:
            for key, i, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if key != w:
                    if len(ids) > 1:
                        parts.append(edges_of(np.array(ids), unit(blobs, width), EMIT))
                    w, ids, blobs = key, [], []
                ids.append(i)
                blobs.append(blob)
            if parts:
                yield batch_of(parts)
                parts = []
        if len(ids) > 1:
            yield batch_of([edges_of(np.array(ids), unit(blobs, width), EMIT)])

    # a seat list has at most 2 x LIST + 1 rows; sorting brings each together in one task
    return seat.join(v.select("id", "v"), "id").select("w", "id", "v").repartition("w").sortWithinPartitions("w").mapInArrow(compare, EDGE)


def forest(hit: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, rows, columns) of each connected part of a matrix of hits; each row and column is visited once."""
    turned, row_left, column_left = np.ascontiguousarray(hit.T), hit.any(axis=1), hit.any(axis=0)
    for first in np.flatnonzero(row_left):
        if not row_left[first]:
            continue
        row_left[first] = False
        rows, columns, edge = [np.array([first])], [], np.array([first])
        while len(edge):
            there = np.flatnonzero(hit[edge].any(axis=0) & column_left)
            column_left[there] = False
            columns.append(there)
            edge = np.flatnonzero(turned[there].any(axis=0) & row_left) if len(there) else there
            row_left[edge] = False
            rows.append(edge)
        yield int(first), np.concatenate(rows), np.concatenate(columns)


def block_links(width: str, threshold: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Links of a block of asked nodes with a block of all nodes: counts, and stars that join what the links join."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        u, v, n = [], [], []
        if left.num_rows and right.num_rows:
            ids, other = left.column("id").to_numpy(), right.column("id2").to_numpy()
            mine, weight, known = left.column("n").to_numpy(), right.column("n2").to_numpy(), right.column("asked2").to_numpy(zero_copy_only=False)
            x, y = unit(left.column("v").to_pylist(), width), unit(right.column("v2").to_pylist(), width)
            hit = np.empty((len(ids), len(other)), bool)
            for at in range(0, len(ids), 512):
                hit[at : at + 512] = (x[at : at + 512] @ y.T >= threshold) & (ids[at : at + 512, None] != other)
            # a null v marks a count; nodes that do not ask themselves are counted from this side
            u, n = [ids, other[~known]], [hit @ weight, (mine @ hit)[~known]]
            v = [np.full(len(ids) + len(u[1]), -1)]
            for first, rows, columns in forest(hit):
                ends = np.concatenate((ids[rows[1:]], other[columns]))
                u.append(np.full(len(ends), ids[first]))
                v.append(ends)
                n.append(np.zeros(len(ends), np.int64))
        u, v, n = (np.concatenate([np.zeros(0, np.int64), *c]).astype(np.int64) for c in (u, v, n))
        count = np.arange(len(u)) < (left.num_rows + int((~known).sum()) if len(u) else 0)
        keep = ~count | (n > 0)
        return pa.table({"u": pa.array(u[keep]), "v": pa.array(v[keep], mask=count[keep]), "links": pa.array(n[keep])})

    return run


def saturated(graph: DataFrame, threshold: float) -> DataFrame:
    """(node): nodes with EMIT links or more, the most that one comparison gives; their lists may lack some."""
    return graph.where(F.col("cos") >= threshold).groupBy("u").count().where(F.col("count") >= min(EMIT, LIST)).select(F.col("u").alias("node"))


def full_links(v: DataFrame, width: str, asked: DataFrame, threshold: float) -> DataFrame:
    """(u, v, links) of the asked nodes compared with every node of their dimension, block by block.

    Rows with null v add to u's count of links with asked nodes (of an asked u: with all nodes);
    the others are stars within connected parts, never more than the rows of a block.
    """
    every = v.join(asked.select(F.col("node").alias("id"), F.lit(True).alias("asked")), "id", "left").select("id", "n", "dim", "v", F.coalesce("asked", F.lit(False)).alias("asked"))
    every = cut(every)
    blocks = lambda c: F.ceil(F.count_if(c) / F.lit(BLOCK)).cast("int")
    sizes = every.groupBy("dim").agg(blocks(F.col("asked")).alias("ask_blocks"), blocks(F.lit(True)).alias("blocks")).where("ask_blocks > 0")
    dealt = lambda m: F.pmod(F.xxhash64("id"), F.col(m).cast("long")).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    rows = every.join(F.broadcast(sizes), "dim")
    left = rows.where("asked").select("dim", dealt("ask_blocks").alias("i"), each("blocks").alias("j"), "id", "n", "v").groupBy("dim", "i", "j")
    right = rows.select(F.col("dim").alias("dim2"), each("ask_blocks").alias("i2"), dealt("blocks").alias("j2"), F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("v").alias("v2"), F.col("asked").alias("asked2")).groupBy("dim2", "i2", "j2")
    return left.cogroup(right).applyInArrow(block_links(width, threshold), "u long, v long, links long")


def audit(v: DataFrame, width: str, graph: DataFrame, linked: DataFrame, of: DataFrame, threshold: float, sample: int = AUDIT) -> float:
    """The least of three shares, each against all nodes: of a linked node's links, those found and
    those within its component, both averaged over a sample of such nodes; and of a sample of
    nodes without links, the nearest to having one, those that have none."""
    placed = v.join(linked, "id", "left").join(of.withColumnRenamed("node", "id"), "id", "left").select("id", "n", "dim", "v", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    placed = cut(placed)
    nearest = graph.groupBy(F.col("u").alias("id")).agg(F.max("cos").alias("cos"))
    drawn = placed.where("links > 0").orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(sample).collect()
    drawn += placed.where("links = 0").join(nearest, "id", "left").orderBy(F.col("cos").desc_nulls_last(), "id").limit(sample).collect()
    by_dim: dict[int, list] = {}
    for r in drawn:
        by_dim.setdefault(r["dim"], []).append(r)
    asked = {d: (np.array([r["id"] for r in x]), np.array([r["component"] for r in x]), unit([bytes(r["v"]) for r in x], width)) for d, x in by_dim.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n, dims, component, blobs = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy(), b.column(4).to_pylist()
            for d in np.intersect1d(dims, list(asked)):
                at = np.flatnonzero(dims == d)
                q, own, x = asked[d]
                hit = (x @ unit([blobs[i] for i in at], width).T >= threshold) & (q[:, None] != ids[at])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(hit @ n[at]), pa.array((hit & (own[:, None] == component[at])) @ n[at])], ["id", "there", "joined"])

    seen = placed.select("id", "n", "dim", "component", "v").mapInArrow(run, "id long, there long, joined long").groupBy("id").agg(F.sum("there").alias("there"), F.sum("joined").alias("joined"))
    seen = {r["id"]: r for r in seen.collect()}  # the sample
    has = [(r["links"], seen[r["id"]]["there"], seen[r["id"]]["joined"]) for r in drawn if r["links"]]
    none = [seen[r["id"]]["there"] == 0 for r in drawn if not r["links"]]
    shares = [[min(1.0, a / t) for a, t, _ in has if t], [j / t for _, t, j in has if t], none]
    return min((float(np.mean(x)) for x in shares if x), default=1.0)


def links_of(v: DataFrame, width: str, graph: DataFrame, asked: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, links) and (node, component): by the lists, and for the asked nodes by comparison with every node."""
    links = graph.where(F.col("cos") >= threshold).select("u", "v")
    links = cut(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    full = cut(full_links(v, width, asked, threshold))
    # links of two nodes that are not asked stand in the lists; all others were compared
    few = links.join(asked, F.col("u") == F.col("node"), "left_anti").join(asked, F.col("v") == F.col("node"), "left_anti")
    sparse = few.join(v.select(F.col("id").alias("v"), "n"), "v").select(F.col("u").alias("id"), F.col("n").alias("links"))
    linked = cut(sparse.unionByName(full.where("v is null").select(F.col("u").alias("id"), "links")).groupBy("id").agg(F.sum("links").alias("links")))
    of = cut(components(few.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(full.where("v is not null").select(F.col("u").alias("a"), F.col("v").alias("b")))))
    return linked, of


def dedup(rows: DataFrame, threshold: float = 0.9, rounds: int = 2, least_recall: float = 0.97, most_rounds: int = 6) -> DataFrame:
    """Per row of (vec_id, embedding): vec_id, n_links, component_id, kept."""
    rows = rows.select("vec_id", "embedding")
    width = WIDTH[rows.schema["embedding"].dataType.simpleString()]
    v = cut(nodes(rows, width))
    graph = cut(merged(sorted_runs(v, width, TABLES, SEED)))
    done, recall = 0, 0.0
    while done < most_rounds and recall < least_recall:
        done += 1
        found = descend(v, width, graph)
        if done > rounds:  # the audit asked for more
            found = found.unionByName(sorted_runs(v, width, MORE_TABLES * done, SEED + done))
        graph = cut(merged(graph.unionByName(found)))
        if done >= rounds:
            linked, of = links_of(v, width, graph, cut(saturated(graph, threshold)), threshold)
            recall = audit(v, width, graph, linked, of, threshold)
    if recall < least_recall:
        linked, of = links_of(v, width, graph, v.select(F.col("id").alias("node")), threshold)
    able = usable("embedding") & F.col("vec_id").isNotNull()
    first = rows.where(able).groupBy("embedding").agg(F.min("vec_id").alias("id"))
    known = v.select("id", "n").join(linked, "id", "left").join(of.select(F.col("node").alias("id"), "component"), "id", "left")
    known = first.join(known, "id").select("embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    alone = rows.where(~F.coalesce(able, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.where(able).join(known, "embedding").select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
