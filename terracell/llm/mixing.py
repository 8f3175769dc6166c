"""Mixing sources to target weights.

Each source's words are packed, document after document, into blocks of fixed length. The mix
is a set of output shards; a source's slots fall on them by a multinomial draw of equal
chances, so that a shard's counts per source are random while the sources' sums meet their
targets whatever the draw. The counts come from a binary tree of seeded binomial draws for each
source, exact at any size: any task finds its own shards' counts in logarithmic time. A
source's slots are numbered on through the shards and mapped by a pseudorandom permutation of
its blocks (a new one each time all have been used), then slots join blocks by index.

Targets are found by rounds of grouped sums over the sources' totals; a source's slots are dealt
to tasks by ranges of shards. Neither sources nor slots are gathered anywhere.

Edge cases: null text has size 0; a null source is a source, the last; documents of size 0 take
0; repeated rows are documents of their own; an empty table gives no rows; very long texts are
many blocks. Equal input gives equal output on every run, whatever the partitioning.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, running, small_batches, stored

WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD).finditer
BLOCK_WORDS, SHARD_SLOTS, TASK_SLOTS, SEED = 64, 1024, 1 << 16, 20240607
BROADCAST_SOURCES = 10_000


def numbered(sources: DataFrame) -> DataFrame:
    """k: the place of each row of (source, size), sources distinct, by code point with null last."""
    order = F.col("source").asc_nulls_last()
    dealt = cut(sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()))
    sizes = {r[0]: r[1] for r in dealt.groupBy("_p").count().collect()}  # a row a partition
    before, base = 0, []
    for p in sorted(sizes):
        base.append((p, before))
        before += sizes[p]
    within = F.row_number().over(Window.partitionBy("_p").orderBy(order)) - 1
    start = sources.sparkSession.createDataFrame(base, "_p int, _base long")
    return dealt.withColumn("_k", within).join(F.broadcast(start), "_p").select((F.col("_k") + F.col("_base")).alias("k"), "source", "size")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(k, source, size, target) of (k, source, size): all words shared by weight, none above ``most`` times its own.

    Sources above their limit stop there and the rest is shared anew, until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("k") % len(weights) + 1).cast("int")).cast("long")
    rows = cut(sources.select("k", "source", "size", weight.alias("w"), (F.col("size") * most).alias("most"), F.lit(False).alias("full")))
    while True:
        size, share, stopped, n_full, n = rows.agg(F.sum("size"), F.sum(F.when(~F.col("full"), F.col("w"))), F.sum(F.when(F.col("full"), F.col("most"))), F.count_if("full"), F.count("*")).first()
        unit = float(size - (stopped or 0)) / share if n_full < n else 0.0
        now = rows.withColumn("full", F.col("full") | (F.lit(unit) * F.col("w") > F.col("most")))
        if now.agg(F.count_if("full")).first()[0] == n_full:
            return rows.select("k", "source", "size", F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.lit(unit) * F.col("w")).alias("target"))
        rows = cut(now)


def permuted(j: np.ndarray, n: int, key: tuple[int, ...]) -> np.ndarray:
    """Images of j (all below n) under a pseudorandom permutation of range(n): Feistel, cycle walking."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask, keys = np.uint64((1 << half) - 1), np.random.default_rng(key).integers(1, 1 << 62, 6, dtype=np.uint64)

    def step(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, left ^ ((mixed * (k | np.uint64(1)) >> np.uint64(20)) & mask)
        return (left << np.uint64(half)) | right

    out = step(j.astype(np.uint64))
    while (far := out >= n).any():
        out[far] = step(out[far])
    return out.astype(np.int64)


def shard_counts(slots: int, shards: int, seed: int, k: int, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
    """(shard, slots before it, slots in it) of source ``k`` for lo <= shard < hi, empty shards left out."""
    todo = [(0, shards, 0, slots)]
    while todo:
        a, b, before, n = todo.pop()
        if not n or b <= lo or a >= hi:
            continue
        if b - a == 1:
            yield a, before, n
            continue
        mid = (a + b) // 2
        left = int(np.random.default_rng([seed, k, a, b]).binomial(n, (mid - a) / (b - a)))
        todo += [(mid, b, before + left, n - left), (a, mid, before, left)]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan(sized: DataFrame, weights: tuple[int, ...], most: int, block_words: int) -> DataFrame:
    """(k, source, source_size, target, per, blocks, slots): a row a source; blocks hold ``per`` words."""
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("size"))
    size, per, blocks = F.col("size"), F.col("per"), F.col("blocks")
    rows = targets(numbered(totals), weights, most).withColumn("per", F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(size / 64))).cast("long"))  # small sources: shorter blocks, for a fine enough count
    rows = rows.withColumn("blocks", F.ceil(size / per).cast("long"))
    slots = F.when(size > 0, F.least(F.round(F.col("target") * blocks / size).cast("long"), most * blocks)).otherwise(0)
    return rows.select("k", "source", size.alias("source_size"), "target", "per", "blocks", slots.cast("long").alias("slots"))


def slots(sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, k, block): the mix, slot by slot; ``total`` of them, in order of (shard, slot)."""
    shards = max(1, -(-total // shard_slots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, blocks, n, part, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = list(shard_counts(n, shards, seed, k, shards * part // parts, shards * (part + 1) // parts))
                if not found:
                    continue
                shard, before, counts = (np.array(c, np.int64) for c in zip(*found, strict=True))
                j = np.arange(before[0], before[-1] + counts[-1])
                block = np.empty(len(j), np.int64)
                for epoch in range(int(j[0]) // blocks, int(j[-1]) // blocks + 1):
                    now = j // blocks == epoch
                    block[now] = permuted(j[now] % blocks, blocks, (seed, k, epoch))
                order = np.random.default_rng([seed, 1, k, part]).integers(0, 1 << 62, len(j))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(shard, counts)), pa.array(order), pa.array(np.full(len(j), k)), pa.array(block)], ["shard", "slot", "k", "block"])

    parts = F.greatest(F.lit(1), F.least(F.lit(shards), F.ceil(F.col("slots") / TASK_SLOTS))).cast("long")
    dealt = sources.where("slots > 0").withColumn("parts", parts).select("k", "blocks", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "parts")
    tasks = max(1, min(4 * sources.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_SLOTS)))
    return dealt.repartition(tasks, "k", "part").mapInArrow(run, "shard long, slot long, k long, block long")


def mixed(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED, order: tuple[str, ...] = ("doc_id", "size")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From (doc_id, source, size): the documents with their place, the slots, and what slots take.

    Documents stand by a hash of the ``order`` columns and then by these; only rows equal in them may change places.

    Documents: doc_id, source, size, source_size, target, k, begin (words of its source before
    it). Slots: shard, slot (a place in the shard's order), k, block. Taken: k, begin, block,
    from_word, to_word (in the document), times.
    """
    sized = cut(sized.select("doc_id", "source", "size"))
    sources = cut(plan(sized, weights, most, block_words))
    n_sources, total = sources.agg(F.count("*"), F.sum("slots")).first()
    frame = sources.drop("slots")
    frame = F.broadcast(frame) if n_sources <= BROADCAST_SOURCES else frame
    placed = sized.alias("d").join(frame.alias("f"), F.col("d.source").eqNullSafe(F.col("f.source"))).select("d.*", "k", "source_size", "target", "per")
    docs = cut(running(placed, ["k"], [F.col(c) for c in order], F.col("size"), "begin", sized.count()))
    all_slots = slots(sources, int(total or 0), shard_slots, seed)
    end = F.col("begin") + F.col("size")
    parts = (
        docs.where("size > 0")
        .select("k", "begin", "size", "per", F.explode(F.sequence(F.floor(F.col("begin") / F.col("per")), F.floor((end - 1) / F.col("per")))).alias("block"))
        .select("k", "begin", "block", (F.greatest(F.col("block") * F.col("per"), F.col("begin")) - F.col("begin")).alias("from_word"), (F.least((F.col("block") + 1) * F.col("per"), F.col("begin") + F.col("size")) - F.col("begin")).alias("to_word"))
    )
    taken = parts.join(all_slots.groupBy("k", "block").agg(F.count("*").alias("times")).hint("merge"), ["k", "block"])
    return docs.drop("per"), all_slots, taken


def mix(docs: DataFrame, **options) -> DataFrame:
    """Per document: size, its source's size and target, and the words that the mix takes of it."""
    placed, _, taken = mixed(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), **options)
    words = taken.groupBy("k", "begin").agg(F.sum((F.col("to_word") - F.col("from_word")) * F.col("times")).alias("taken"))
    out = placed.where("size > 0").join(words.hint("merge"), ["k", "begin"], "left").unionByName(placed.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix_texts(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: copy c of a document holds its words in blocks taken more than c times.

    Keeps the columns of ``docs``, with text and n_chars rewritten; a document that no slot
    takes is left out. Every row is a document of its own, repeated rows too; extra columns may
    have any name. Null texts have no words and are left out.
    """
    names = docs.columns
    row, copies = fresh(docs, "_row", "_copies")
    small_batches(docs.sparkSession)
    # rows get a number, fixed by being written; places go by content, so equal rows alone can change places
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    key = F.struct("doc_id", F.xxhash64("text").alias("h"), F.col(row).alias("row"))
    placed, _, taken = mixed(whole.select(key.alias("doc_id"), "source", word_count(F.col("text")).alias("size")), order=("doc_id.doc_id", "doc_id.h", "size"), **options)
    ranges = (
        taken.select("k", "begin", "from_word", "to_word", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"))
        .groupBy("k", "begin", "copy")
        .agg(F.sort_array(F.collect_list(F.struct("from_word", "to_word"))).alias("ranges"))  # the blocks of one document
        .join(placed.where("size > 0").select("k", "begin", F.col("doc_id.row").alias("row")).hint("merge"), ["k", "begin"])
        .groupBy("row")
        .agg(F.collect_list("ranges").alias("copies"))
    )
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part, rows, texts = batch.slice(start, 64), [], []
                for i, (text, copies_) in enumerate(zip(part.column(at), part.column(len(names)).to_pylist(), strict=True)):
                    for ranges_ in copies_:
                        rows.append(i)
                        texts.append(words_of(text.as_py(), ranges_))
                taken_rows = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if k == at else taken_rows.column(k) for k in range(len(names))], names)

    joined = whole.alias("d").join(ranges.alias("r").hint("merge"), F.col(f"d.{row}") == F.col("r.row"))
    out = joined.select(*[F.col(f"d.`{c}`") for c in names], F.col("r.copies").alias(copies)).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out


def words_of(text: str, ranges: list[dict]) -> str:
    """The words in the ranges: those that touch as they stand in the text, others on new lines."""
    spans = [m.span() for m in _WORD(text)]
    joined: list[list[int]] = []
    for r in ranges:
        if joined and joined[-1][1] == r["from_word"]:
            joined[-1][1] = r["to_word"]
        else:
            joined.append([r["from_word"], r["to_word"]])
    return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in joined)
