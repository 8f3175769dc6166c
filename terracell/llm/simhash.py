"""SimHash near-dedup by a segment-popcount embedding.

A document's fingerprint has bit b set where over half of its shingle hashes have. Sixteen
4-bit segments embed it as the vector of their popcounts; Manhattan distance between vectors
never exceeds Hamming distance, so two fingerprints within 2 bits both reach a common grid
cell by a step of at most one count. Fingerprints therefore go to their own cell and its
neighbours; cells with one fingerprint end there. In the others the common cell holds a
bit pattern within one bit of both: members meet at it and are linked to its smallest, each
link verified on the fingerprints. A cell of any size costs its members' few patterns, never
all pairs, and no link between components is lost. Groups are the components of the links.

Edge cases: null or empty text has fingerprint zero and links like any other; fewer words than
a shingle make one shingle; very long texts are hashed in slices; repeated rows and copies
share a fingerprint, hence a group; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, fresh, matched, own_shuffles, small_batches, stored

SEGMENTS, WIDTH, SLICE = 16, 4, 1 << 16


def shingle_hashes(text: bytes, words: int, seed: int) -> Iterator[np.ndarray]:
    """XXH64 of each run of ``words`` words, A-Z lowered, in slices."""
    found = text.lower().split()  # bytes: A-Z, and cuts at space and \t to \r
    if not found:
        return
    runs = map(b" ".join, zip(*(islice(found, k, None) for k in range(words)), strict=False)) if len(found) >= words else iter([b" ".join(found)])
    hashes = map(xxhash.xxh64_intdigest, runs, repeat(seed))
    while len(part := np.fromiter(islice(hashes, SLICE), dtype="<u8")):
        yield part


def majority(hashes: Iterator[np.ndarray]) -> int:
    """The fingerprint: bit b is set where over half of the hashes have it."""
    ones, n = np.zeros(64, np.int64), 0
    for h in hashes:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    return majority(shingle_hashes(text, words, seed))


def popcounts(x: np.ndarray) -> np.ndarray:
    """The popcount of each 4-bit segment of uint64 x, in that segment's place."""
    a, b = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333)
    x = (x & a) + ((x >> np.uint64(1)) & a)
    return (x & b) + ((x >> np.uint64(2)) & b)


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp, cell): the fingerprint and its grid cell, as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            fp = np.fromiter((fingerprint(t.as_py() or b"", words, seed) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), pa.array(popcounts(fp).view(np.int64))], ["doc_id", "fp", "cell"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long, cell long")


def links(prints: DataFrame) -> DataFrame:
    """(a, b) links between distinct fingerprints of (fp, cell) within 2 bits, as stars.

    Every pair within 2 bits is joined by a path of links, and every link is such a pair.
    """
    near = [F.struct(F.col("cell").alias("near"), F.lit(0).alias("step"), F.lit(0).alias("at"))]
    for s in range(SEGMENTS):
        at, count = s * WIDTH, F.shiftright("cell", s * WIDTH).bitwiseAND(7)
        near.append(F.when(count < WIDTH, F.struct((F.col("cell") + F.lit(1 << at)).alias("near"), F.lit(1).alias("step"), F.lit(at).alias("at"))))
        near.append(F.when(count > 0, F.struct((F.col("cell") - F.lit(1 << at)).alias("near"), F.lit(-1).alias("step"), F.lit(at).alias("at"))))
    cells = prints.select("fp", F.explode(F.array(*near)).alias("n")).where("n is not null").select("fp", "n.*")
    busy = cells.groupBy("near").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).where("x <> y").select("near")
    patterns = matched(cells, busy, "near").select(
        "fp",
        F.explode(F.expr("if(step = 0, array(fp), transform(filter(sequence(at, at + 3), p -> (shiftright(fp, p) & 1) = if(step > 0, 0, 1)), p -> fp ^ shiftleft(1L, p)))")).alias("pattern"),
    )
    patterns = cut(patterns)
    hubs = patterns.groupBy("pattern").agg(F.min("fp").alias("a"), F.max("fp").alias("y")).where("a <> y").select("pattern", "a")
    return matched(patterns, hubs, "pattern").where("fp <> a and bit_count(fp ^ a) <= 2").select("a", F.col("fp").alias("b")).distinct()


def groups(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """Per document: doc_id, fp (long), component_id (the smallest doc_id reachable by links)."""
    prints = cut(fingerprints(docs, words, seed))
    of = components(links(prints.select("fp", "cell").distinct()))
    rooted = matched(prints, of.select(F.col("node").alias("fp"), "component"), "fp", "left").select("doc_id", "fp", F.coalesce("component", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return matched(rooted, first, "root").select("doc_id", "fp", "component_id")


BINS, ROWS = 256, 8


def shingle_set(text: bytes, words: int, seed: int) -> np.ndarray:
    """The distinct shingle hashes, in order."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingle_hashes(text, words, seed)]))


def sketch(h: np.ndarray) -> np.ndarray:
    """The smallest shingle hash of each of 256 bins, 32 bits each; an empty bin borrows the next one's."""
    out = np.zeros(BINS, np.uint32)
    if len(h):
        bins = h >> np.uint64(64 - BINS.bit_length() + 1)
        first = np.concatenate(([True], bins[1:] != bins[:-1]))
        full, low = bins[first].astype(np.int64), (h[first] >> np.uint64(24)).astype(np.uint32)
        at = np.searchsorted(full, np.arange(BINS)) % len(full)
        out = low[at] + ((full[at] - np.arange(BINS)) % BINS).astype(np.uint32) * np.uint32(0x9E3779B1)
    return out


_ODD = np.random.default_rng(77).integers(0, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_keys(sketched: np.ndarray) -> np.ndarray:
    """One number for each run of ROWS bins: equal if the bins are."""
    mixed = (sketched.reshape(-1, ROWS).astype(np.uint64) * _ODD).sum(axis=1, dtype=np.uint64) * _ODD[0]
    return (mixed ^ (mixed >> np.uint64(31))).view(np.int64)


MOST_KEPT, ERRORS = 1 << 22, 4.8


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, similarity: float, seed: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose whole shingle sets have Jaccard similarity of at least ``similarity``.

    Sets whose sizes differ too much go first, then those whose sketches agree in fewer bins than
    ``ERRORS`` standard errors below the similarity; the others' texts are compared.
    """

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low = np.minimum(b.column(2).to_numpy(), b.column(3).to_numpy())
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, BINS) for c in (4, 5))
            least = similarity - ERRORS * np.sqrt(similarity * (1 - similarity) / np.clip(low, 1, BINS))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in (0, 1)], ["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        held = 0

        def of(key: int, text: pa.Scalar) -> np.ndarray:
            nonlocal held
            if key not in known:
                if held > MOST_KEPT:
                    known.clear()
                    held = 0
                known[key] = shingle_set(text.as_py(), words, seed)
                held += len(known[key])
            return known[key]

        for batch in batches:
            ok = []
            columns = (batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary()))
            for i, (a, b, s, t) in enumerate(zip(*columns, strict=True)):
                x, y = of(a, s), of(b, t)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= similarity * (len(x) + len(y) - both) - 1e-9:
                    ok.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(ok, pa.int64())) for k in (0, 1)], ["a", "b"])

    side = lambda end: nodes.select(F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("sketch").alias(f"sketch_{end}"))
    near = matched(matched(pairs, side("a"), "a"), side("b"), "b").where(F.least("size_a", "size_b") >= similarity * F.greatest("size_a", "size_b") - 1e-9)
    near = cut(near.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(close, "a long, b long"))
    wanted = matched(nodes, near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node").select("node", "one.doc_id", "one.h")
    has = stored(matched(texts, wanted, ["doc_id", "h"]).dropDuplicates(["node"]).select("node", "text"))
    whole = matched(matched(near, has.select(F.col("node").alias("a"), F.col("text").alias("s")), "a"), has.select(F.col("node").alias("b"), F.col("text").alias("t")), "b")
    return cut(whole.select("a", "b", "s", "t").mapInArrow(alike, "a long, b long"))


FEW, TILE, TILE_SHINGLES, STRIP, LEVEL = 16, 512, 1 << 20, 2048, 4


def joined(sets: list[np.ndarray], of: np.ndarray, similarity: float) -> np.ndarray:
    """For each of the sets the number of the first one that it is linked to, over any path of links
    (Jaccard of at least ``similarity``) between sets of different ``of``; all pairs are held exactly."""
    n = len(sets)
    row = np.repeat(np.arange(n), [len(x) for x in sets])
    known, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[at] > 1  # what one set alone has counts in its size only
    column = (np.cumsum(count > 1) - 1)[at[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[shared][order], column[order]
    both, width = np.zeros((n, n), np.float64), int((count > 1).sum())
    for low in range(0, width, STRIP):
        a, b = np.searchsorted(column, (low, low + STRIP))
        has = np.zeros((n, min(STRIP, width - low)), np.float32)
        has[row[a:b], column[a:b] - low] = 1
        both += has @ has.T
    size = np.array([len(x) for x in sets], np.float64)
    linked = (both >= similarity * (size[:, None] + size - both) - 1e-9) & (of[:, None] != of)
    np.fill_diagonal(linked, True)
    first = np.arange(n)
    while True:
        least = np.where(linked, first, n).min(axis=1)
        if (least == first).all():
            return first
        first = least


def tiled(members: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, similarity: float, seed: int) -> DataFrame:
    """Links (a, b) that join what exact similarity joins among the ``members`` (band, key, node, of) of large groups.

    A group of one (band, key) is cut by size, since sets linked differ in size by no more than the
    similarity, and then into blocks of at most about 512 sets and 2^20 shingles. Those outside
    the group's largest component meet each other's blocks and that component's, two blocks a
    task, which counts common shingles by a product of incidence matrices. A task gives
    one link for each set that something joins, never the pairs; a member travels once for every block it
    meets, a 512th of its pairs.
    """
    ratio = math.log(1 / similarity) * (1 + 1e-9) if similarity > 0 else math.inf
    # linked sets lie within one step; a level is LEVEL steps, and a level's lowest step also meets the level below
    step = F.floor(F.log("size") / F.lit(ratio)).cast("int") if similarity < 1 else F.col("size") * LEVEL
    own = F.floor(step / LEVEL).cast("int")
    sized = matched(members, nodes.select("node", "size"), "node").withColumn("own", own)
    sized = sized.withColumn("level", F.explode(F.when((step % LEVEL == 0) & F.lit(similarity < 1), F.array("own", F.col("own") - 1)).otherwise(F.array("own"))))
    group = ["band", "key", "level"]
    parts = sized.groupBy(*group, "of").agg(F.count("*").alias("n"), F.max("size").alias("s"), F.min("own").alias("own"))
    groups_ = parts.groupBy(*group).agg(F.sum("n").alias("m"), F.max("s").alias("s"), F.max_by("of", F.struct("n", "of")).alias("main"), F.max("n").alias("in_main"), F.min("own").alias("own")).where("m > in_main and own = level")
    per = F.least(F.lit(TILE), F.greatest(F.lit(1), F.floor(F.lit(TILE_SHINGLES) / F.col("s"))))
    plan = groups_.select(*group, "main", F.ceil((F.col("m") - F.col("in_main")) / per).cast("int").alias("p"), F.ceil(F.col("in_main") / per).cast("int").alias("q"))
    dealt = matched(sized, plan, group)
    inside = F.col("of") == F.col("main")
    spread = F.xxhash64("node", F.lit(seed))
    dealt = dealt.withColumn("i", F.when(inside, F.col("p") + F.pmod(spread, F.col("q"))).otherwise(F.pmod(spread, F.col("p"))).cast("int"))
    # every block has a partner (p and q are at least 1), and is compared with itself there
    partners = F.when(inside, F.expr("sequence(0, p - 1)")).otherwise(F.expr("filter(sequence(0, p + q - 1), x -> x <> i)"))
    spots = dealt.select(*group, "node", "of", "i", F.explode(partners).alias("j"))
    spots = spots.select(*group, F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "node", "of")

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py() or b"", words, seed).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "hashes"])

    wanted = matched(nodes, members.select("node").distinct(), "node").select("node", "one.doc_id", "one.h")
    sets = stored(matched(texts, wanted, ["doc_id", "h"]).dropDuplicates(["node"]).select("node", "text").mapInArrow(draw, "node long, hashes binary"))

    def link(tile: pa.Table) -> pa.Table:
        node = tile.column("node").to_numpy()
        first = joined([np.frombuffer(x.as_py(), np.uint64) for x in tile.column("hashes")], tile.column("of").to_numpy(), similarity)
        to = first != np.arange(len(first))
        return pa.table({"a": node[first[to]], "b": node[to]})

    return cut(matched(spots, sets, "node").groupBy(*group, "i", "j").applyInArrow(link, "a long, b long").distinct())


def similar_rows(docs: DataFrame, words: int = 5, similarity: float = 0.8, seed: int = 42) -> DataFrame:
    """(doc_id, h, root): rows with equal root are joined by links of shingle similarity (Jaccard) of at least ``similarity``.

    Three rounds find pairs, whole shingle sets decide each, and components join them:
    fingerprints within 2 bits meet in the grid; documents whose sketches agree in a run of
    bins meet a hub that differs from run to run, which joins large groups of copies by few
    pairs; then every two that meet in a run and are not joined yet are compared: as pairs
    where up to ``FEW`` meet, else block by block (``tiled``). The sketches
    are needed since pairs as similar as 0.8 differ in up to sixteen fingerprint bits, out of
    the grid's reach. Equal sets are one node. h tells different texts of one doc_id apart.
    Rows without doc_id are left out.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                b = whole.slice(start, 1024)
                sets, fps = [], []
                for t in b.column(2).cast(pa.binary()):
                    hashes = list(shingle_hashes(t.as_py() or b"", words, seed))
                    fps.append(majority(iter(hashes)))
                    sets.append(np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes])))
                sketches = [sketch(x) for x in sets]
                node = np.fromiter((xxhash.xxh64_intdigest(x.tobytes()) for x in sets), np.uint64, len(sets)).view(np.int64)
                fp = np.array(fps, np.uint64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * (BINS // ROWS), pa.int32()), pa.array(np.concatenate([band_keys(x) for x in sketches])))
                small = pa.array([x.astype(np.uint8).tobytes() for x in sketches], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node), pa.array([len(x) for x in sets], pa.int32()), pa.array(fp.view(np.int64)), pa.array(popcounts(fp).view(np.int64)), bands, small], ["doc_id", "h", "node", "size", "fp", "cell", "bands", "sketch"])

    small_batches(docs.sparkSession)
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text")
    drawn = stored(texts.mapInArrow(draw, "doc_id long, h long, node long, size int, fp long, cell long, bands array<long>, sketch binary"))
    # equal sets have equal sizes and sketches
    nodes = stored(drawn.groupBy("node").agg(F.min(F.struct("doc_id", "h")).alias("one"), *[F.first(c).alias(c) for c in ("size", "fp", "cell", "bands", "sketch")]))
    some = nodes.where("size > 0")
    sides = lambda pairs: pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    with own_shuffles(docs.sparkSession):
        first_of = some.groupBy("fp").agg(F.min("node").alias("hub"))
        grid = matched(matched(links(some.select("fp", "cell").distinct()), first_of.withColumnsRenamed({"fp": "a", "hub": "x"}), "a"), first_of.withColumnsRenamed({"fp": "b", "hub": "y"}), "b")
        same = matched(some.select("fp", F.col("node").alias("y")), first_of, "fp").select(F.col("hub").alias("x"), "y")
        near = cut(sides(grid.select("x", "y").unionByName(same)))
        bands = some.select("node", F.posexplode("bands").alias("band", "key"))
        hubs = bands.groupBy("band", "key").agg(F.min(F.struct(F.xxhash64("band", "node").alias("r"), "node")).alias("hub"), F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y")
        met = stored(matched(bands, hubs.select("band", "key", F.col("hub.node").alias("a")), ["band", "key"]).select("band", "key", "a", "node"))
        first = cut(near.unionByName(sides(met.select(F.col("a").alias("x"), F.col("node").alias("y")))).distinct())
        links_ = verified(first, nodes, texts, words, similarity, seed)
        of = components(links_)
        apart = matched(met, of, "node", "left").select("band", "key", "node", F.coalesce("component", "node").alias("of"))
        mixed = apart.groupBy("band", "key").agg(F.min("of").alias("x"), F.max("of").alias("y"), F.count("*").alias("m")).where("x <> y")
        apart = cut(matched(apart, mixed.select("band", "key", "m"), ["band", "key"]))
        few = apart.where(F.col("m") <= FEW).drop("m")
        other = few.select("band", "key", F.col("node").alias("b"), F.col("of").alias("of_b"))
        rest = matched(few.withColumnRenamed("node", "a"), other, ["band", "key"]).where("a < b and of <> of_b").select("a", "b").distinct()
        rest = matched(rest, first, ["a", "b"], "left_anti")
        found = [links_, verified(rest, nodes, texts, words, similarity, seed)]
        many = apart.where(F.col("m") > FEW).drop("m")
        if many.limit(1).count():
            found.append(tiled(many, nodes, texts, words, similarity, seed))
        of = components(reduce(DataFrame.unionByName, found))
    return matched(drawn.select("doc_id", "h", "node"), of, "node", "left").select("doc_id", "h", F.coalesce("component", "node").alias("root"))


def similar_groups(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, component_id): the smallest doc_id reachable by links of ``similar_rows``; a row a row of ``docs`` with doc_id."""
    rooted = similar_rows(docs, **options)
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return matched(rooted, least, "root").select("doc_id", "component_id")


def first_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of similar texts: that of smallest doc_id (then text hash).

    Edge cases: null and empty texts have the empty set and are one group; different texts
    under one doc_id are judged each by itself; of rows equal in doc_id and text the smallest by
    all columns stays; rows without doc_id all stay; an empty table stays empty; extra columns may have any name.
    """
    rooted = cut(similar_rows(docs, **options))
    kept = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("one"))
    again = rooted.groupBy("doc_id", "h").agg(F.count("*").alias("n"))
    kept = cut(matched(kept, again, (F.col("one.doc_id") == F.col("doc_id")) & (F.col("one.h") == F.col("h"))).select("doc_id", "h", "n"))
    key, h, n, row = fresh(docs, "_id", "_h", "_n", "_row")
    found = matched(docs.withColumn(key, F.col("doc_id").cast("long")).withColumn(h, F.xxhash64("text")), kept.withColumnsRenamed({"doc_id": key, "h": h, "n": n}), [key, h])
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = found.where(F.col(n) == 1).select(columns)
    if kept.where("n > 1").limit(1).count():
        repeated = found.where(F.col(n) > 1).groupBy(key, h).agg(F.min(F.struct(*columns)).alias(row))
        out = out.unionByName(repeated.select(*[F.col(f"{row}.`{c}`") for c in docs.columns]))
    return out.unionByName(docs.where("doc_id is null"))
