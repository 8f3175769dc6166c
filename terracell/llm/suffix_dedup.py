"""Removal of repeated byte strings by common-prefix interval trees of an enhanced suffix array.

A byte goes when a ``length``-byte string that covers it also starts in a document with a
smaller doc_id. Finding those strings over any number of documents:

1. Winnowing: every window of ``length`` bytes has one smallest ``GRAM``-byte gram by hash, its
   anchor, which depends on the window alone. An anchor (about one for eighteen bytes) stands
   for a run of windows, whose bytes are its context; texts are sampled as their anchors' and
   contexts' hashes.
2. One sort of these by anchor and context finds the contexts that a smaller document has: all
   their bytes go. The smallest document of a context keeps it, and needs a closer look only
   if its anchor has other contexts as well. A passage in a third of all documents is one
   context there.
3. Contexts that share an anchor share a subtree of the suffix tree, so anchors deal the suffix
   array into independent parts. Each part sorts the suffixes whose first ``length`` bytes are
   there more than once (others are in no interval of that length), takes common prefixes of
   neighbours and scans them with a stack into the tree of intervals. Intervals of at least
   ``length`` bytes whose occurrences differ in the byte to the left are maximal repeats; all
   their occurrences but those of the smallest document are marked. Intervals that do not
   differ there are covered by the one a byte to the left. An anchor with more than ``most``
   contexts is not gathered anywhere: its contexts are dealt on, window by window, and the
   smallest document of each window keeps it.
4. Marks go to the texts.

Equal contexts are known by 96 bits of hash, windows of very frequent anchors by 96 bits too;
all others are compared byte by byte.

Edge cases: null text is empty; texts shorter than ``length`` lose nothing; rows without doc_id
lose nothing and take nothing from others; repeated rows are one document, and different texts
under one doc_id are told apart by their hash; an empty table gives no rows; very long texts
are read whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LENGTH, GRAM, SLAB = 50, 16, 1 << 15
_XXH3 = xxhash.xxh3_64_intdigest
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LOW, _PLACES = np.uint64(0xFFFF), np.arange(1 << 16, dtype=np.uint64)
_S29, _S32 = np.uint64(29), np.uint64(32)


def gram_hashes(x: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` bytes from each position (by doubling), in slabs that stay in cache."""
    n = len(x) - size + 1
    out = np.empty(max(0, n), np.uint64)
    for at in range(0, n, SLAB):
        h = x[at : at + SLAB + size - 1].astype(np.uint64) + np.uint64(1)
        h *= _A
        k = 1
        while k < size:
            step = min(k, size - k)
            h = h[:-step] * _B + h[step:]
            h ^= h >> _S29
            k += step
        h *= _A
        h ^= h >> _S32
        out[at : at + SLAB] = h
    return out


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, hashes, first window): each anchor and the first window start that it stands for.

    Window starts from one anchor's first to the next one's are the windows whose leftmost
    smallest gram, by the upper 48 bits of its hash, is that anchor.
    """
    h = gram_hashes(np.frombuffer(data, np.uint8))
    wide = length - GRAM + 1
    n = len(h) - wide + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    of = np.empty(n, np.int64)
    for start in range(0, n, SLAB):
        part = h[start : start + SLAB + wide - 1]
        low, span = (part & ~_LOW) | _PLACES[: len(part)], 1
        while span < wide:  # sliding minimum by doubling
            step = min(span, wide - span)
            low = np.minimum(low[:-step], low[step:])
            span += step
        of[start : start + SLAB] = (low & _LOW).astype(np.int64) + start
    firsts = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1))
    pos = of[firsts]
    return pos, h[pos], firsts


def context_hashes(data: bytes, firsts: np.ndarray, length: int) -> list[int]:
    """The hash of each anchor's context: the bytes of all its windows."""
    view, ends = memoryview(data), [*firsts[1:].tolist(), len(data) - length + 1]
    return [_XXH3(view[a : b + length - 1]) for a, b in zip(firsts.tolist(), ends, strict=True)]


def samples(docs: DataFrame, length: int) -> DataFrame:
    """(h, ch, doc): the anchors (32 bits) and contexts of each document, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, context, ids = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                data = text.as_py()
                _, h, firsts = anchors(data, length)
                if len(h):
                    ch, once = np.unique(np.array(context_hashes(data, firsts, length), np.uint64), return_index=True)
                    context.append(ch)
                    anchor.append(h[once])
                    ids.append(np.full(len(ch), doc, np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(anchor) >> _S32).astype(np.uint32).view(np.int32)), pa.array(np.concatenate(context).view(np.int64)), pa.array(np.concatenate(ids))], ["h", "ch", "doc"])

    return docs.mapInArrow(run, "h int, ch long, doc long")


def verdicts(found: DataFrame) -> DataFrame:
    """(doc, x): the contexts, as array<struct<ch, gone>>, that are gone or need a closer look.

    Windows keep the first row, or look one row back and ahead, so an anchor of any frequency
    streams by.
    """
    earlier = Window.partitionBy("h", "ch").orderBy("doc").rowsBetween(Window.unboundedPreceding, 0)
    rows = found.repartition("h").select("h", "ch", "doc", (F.first("doc").over(earlier) < F.col("doc")).alias("gone"))
    # both windows keep the one shuffle's partitioning
    by_class = Window.partitionBy("h", "gone").orderBy("ch")
    near = rows.withColumn("more", F.lag("ch").over(by_class).isNotNull() | F.lead("ch").over(by_class).isNotNull())
    return near.where("gone or more").groupBy("doc").agg(F.collect_list(F.struct("ch", "gone")).alias("x"))


CONTEXT = "doc long, th long, h long, ctx binary, begin long, stop long"


def contexts(docs: DataFrame, info: DataFrame, length: int) -> DataFrame:
    """Rows with ctx: contexts for a closer look, from ``begin`` to ``stop``. Without: bytes that are gone."""

    def rows(doc: list, th: list, h: np.ndarray | None, ctx: list[bytes] | None, begin: list, stop: list) -> pa.RecordBatch:
        longs = lambda x: pa.array(np.concatenate(x))
        n = sum(map(len, begin))
        columns = [longs(doc), longs(th), pa.nulls(n, pa.int64()) if h is None else pa.array(h), pa.nulls(n, pa.binary()) if ctx is None else pa.array(ctx, pa.binary()), longs(begin), longs(stop)]
        return pa.RecordBatch.from_arrays(columns, ["doc", "th", "h", "ctx", "begin", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lost, looked, marks, ctx = ([], [], [], []), ([], [], [], []), [], []  # doc, th, begin and stop of each kind
                x = batch.column(3)
                at, ch, gone = x.offsets.to_numpy(), x.values.field(0).to_numpy(), x.values.field(1).to_numpy(zero_copy_only=False)
                for k, (doc, th, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True)):
                    data = text.as_py()
                    _, h, begin = anchors(data, length)
                    if not len(h):
                        continue
                    end = np.append(begin[1:], len(data) - length + 1)
                    mine = np.array(context_hashes(data, begin, length), np.uint64).view(np.int64)
                    own, out = ch[at[k] : at[k + 1]], gone[at[k] : at[k + 1]]
                    order = np.lexsort((~out, own))
                    own, out = own[order], out[order]
                    near = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                    known, out = own[near] == mine, out[near]
                    went, look = known & out, np.flatnonzero(known & ~out)
                    edge = np.flatnonzero(np.diff(went, prepend=False, append=False))  # runs of contexts that are gone
                    for kind, b, e in ((lost, begin[edge[::2]], end[edge[1::2] - 1]), (looked, begin[look], end[look])):
                        for c, value in zip(kind, (np.full(len(b), doc), np.full(len(b), th), b, e + length - 1), strict=True):
                            c.append(value)
                    marks.append(h[look])
                    ctx += [data[b:e] for b, e in zip(looked[2][-1].tolist(), looked[3][-1].tolist(), strict=True)]
                if marks:
                    yield rows(*lost[:2], None, None, *lost[2:])
                    yield rows(*looked[:2], np.concatenate(marks).view(np.int64), ctx, *looked[2:])

    return docs.join(info, "doc").select("doc", "th", "text", "x").mapInArrow(run, CONTEXT)


def common_prefixes(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Common prefix of each row of bytes with the one before it (0 for the first)."""
    out = np.zeros(len(rows), np.int64)
    for at in range(1, len(rows), 1 << 14):
        a, b = rows[at - 1 : at - 1 + (1 << 14)], rows[at : at + (1 << 14)]
        a = a[: len(b)]
        differ = a != b
        n = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[at : at + len(b)] = np.minimum(n, np.minimum(sizes[at - 1 : at - 1 + len(b)], sizes[at : at + len(b)]))
    return out


def maximal_repeats(lcp: list[int], docs: list[int], left: list[int], least: int) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, length, smallest doc) of the interval tree's nodes that are left-diverse.

    Stack scan of an enhanced suffix array: lcp[i] is the common prefix of suffixes i-1 and i;
    ``left`` is the byte before a suffix, -1 where its context begins.
    """
    stack: list[list[int]] = []  # [length, first, smallest doc, left byte or -2 when they differ]

    def both(a: int, b: int) -> int:
        return a if a == b and a >= 0 else -2

    for i in range(1, len(lcp) + 1):
        now = lcp[i] if i < len(lcp) else 0
        first, doc, byte = i - 1, docs[i - 1], left[i - 1] if left[i - 1] >= 0 else -2
        while stack and stack[-1][0] > now:
            length, first, low, seen = stack.pop()
            doc, byte = min(low, doc), both(seen, byte)
            if byte == -2:
                yield first, i - 1, length, doc
        if now >= least:
            if stack and stack[-1][0] == now:
                stack[-1][2], stack[-1][3] = min(stack[-1][2], doc), both(stack[-1][3], byte)
            else:
                stack.append([now, first, doc, byte])


def met_again(h: np.ndarray) -> np.ndarray:
    """Which of the values are there more than once."""
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def repeats(ctx: np.ndarray, size: np.ndarray, docs: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(row, from, to): bytes of contexts, which lie one behind the other, that a context of a smaller document has too.

    A suffix whose first ``length`` bytes no other one has is in no interval of that length; by
    the hash of these bytes it does not enter the suffix array. Equal hashes prove nothing: what enters is compared by bytes.
    """
    windows = size - length + 1
    row = np.repeat(np.arange(len(size)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = (np.cumsum(size) - size)[row] + offset
    enters = np.flatnonzero(met_again(gram_hashes(ctx, length)[start]))
    if not len(enters):
        return
    row, offset, start = row[enters], offset[enters], start[enters]
    left_over = size[row] - offset
    wide = int(left_over.max())
    flat = np.concatenate((ctx, np.zeros(wide, np.uint8)))
    suffixes = np.lib.stride_tricks.sliding_window_view(flat, wide)[start]
    suffixes[np.arange(wide) >= left_over[:, None]] = 0
    order = np.argsort(suffixes.view(f"S{wide}").ravel(), kind="stable")
    suffixes, left_over, row, offset = suffixes[order], left_over[order], row[order], offset[order]
    lcp = common_prefixes(suffixes, left_over)
    before = np.where(offset > 0, flat[start[order] - 1].astype(np.int64), -1)
    doc = docs[row]
    # runs of suffixes with ``length`` bytes in common; those of one document, or without diversity to the left, give nothing
    heads = np.flatnonzero(lcp < length)
    ends = np.append(heads[1:], len(lcp))
    diverse = (np.minimum.reduceat(before, heads) != np.maximum.reduceat(before, heads)) | (np.minimum.reduceat(before, heads) < 0)
    several = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
    for a, b in zip(heads[diverse & several].tolist(), ends[diverse & several].tolist(), strict=True):
        for first, last, n, owner in maximal_repeats([0, *lcp[a + 1 : b].tolist()], doc[a:b].tolist(), before[a:b].tolist(), length):
            for i in range(a + first, a + last + 1):
                if doc[i] > owner:
                    yield int(row[i]), int(offset[i]), int(offset[i]) + n


def solved(part: pa.RecordBatch, length: int) -> pa.RecordBatch:
    """(doc, th, a, b) of whole groups of (doc, th, h, ctx, begin); windows of different anchors are never equal."""
    doc, th, begin = (part.column(k).to_numpy() for k in (0, 1, 4))
    x = part.column(3).cast(pa.binary())
    at = np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1].astype(np.int64)
    flat = np.frombuffer(x.buffers()[2], np.uint8)[at[0] : at[-1]]
    k, a, b = np.array(list(repeats(flat, np.diff(at), doc, length)), np.int64).reshape(-1, 3).T
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (doc[k], th[k], begin[k] + a, begin[k] + b)], ["doc", "th", "a", "b"])


def close_look(found: DataFrame, length: int, most: int = 4096) -> DataFrame:
    """(doc, th, a, b): what contexts lose to others with their anchor."""
    looked = found.where("ctx is not null").select("doc", "th", "h", "ctx", "begin")
    hot = stored(looked.groupBy("h").count().where(F.col("count") > most).select("h"))

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # the last anchor's rows, which may go on
        for batch in batches:
            whole = pa.concat_batches([*rest, batch])
            h = whole.column(2).to_numpy()
            ends, start = np.flatnonzero(h[1:] != h[:-1]) + 1, 0
            while len(ends):  # as many groups as ``most`` rows hold, solved together
                last = max(0, int(np.searchsorted(ends, start + most, "right")) - 1)
                yield solved(whole.slice(start, ends[last] - start), length)
                start, ends = int(ends[last]), ends[last + 1 :]
            rest = [whole.slice(start)]
        if rest and rest[0].num_rows:
            yield solved(rest[0], length)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                part = whole.slice(start, 1024)
                doc, th, h, begin, x, y = [], [], [], [], [], []
                for d, t, g, ctx, at in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    n = len(ctx) - length + 1
                    doc += [d] * n
                    th += [t] * n
                    h += [g] * n
                    begin += range(at, at + n)
                    x += [_XXH3(ctx[o : o + length]) for o in range(n)]
                    y += [xxhash.xxh32_intdigest(ctx[o : o + length]) for o in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(th), pa.array(h), pa.array(begin), _longs(x), pa.array(y, pa.int64())], ["doc", "th", "h", "begin", "x", "y"])

    ordered = looked.join(hot, "h", "left_anti").select("doc", "th", "h", "ctx", "begin").repartition("h").sortWithinPartitions("h")
    lost = ordered.mapInArrow(groups, "doc long, th long, a long, b long")
    if hot.isEmpty():
        return lost
    each = looked.join(hot, "h", "left_semi").select("doc", "th", "h", "ctx", "begin").mapInArrow(windows, "doc long, th long, h long, begin long, x long, y long")
    owner = each.groupBy("h", "x", "y").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).where("owner <> last").select("h", "x", "y", "owner")
    more = each.join(owner, ["h", "x", "y"]).where(F.col("doc") > F.col("owner"))
    return lost.unionByName(more.select("doc", "th", F.col("begin").alias("a"), (F.col("begin") + length).alias("b")))


def _longs(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, th, spans): the bytes to remove from each text of (doc, th, text), unmerged, by begin."""
    known = docs.where("doc is not null")
    found = stored(contexts(known, verdicts(samples(known.select("doc", "text"), length)), length))
    lost = close_look(found, length).unionByName(found.where("ctx is null").select("doc", "th", F.col("begin").alias("a"), F.col("stop").alias("b")))
    return stored(lost.groupBy("doc", "th").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans")))


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))


def kept(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of the bytes, and the number of maximal runs that went."""
    left, at, runs, end = [], 0, 0, -1
    for a, b in spans:
        if a > end:
            runs += 1
            left.append(data[at:a])
        end = max(end, b)
        at = end
    return b"".join([*left, data[at:]]), runs


def dedup(docs: DataFrame, length: int = LENGTH, texts: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes kept."""
    docs = keyed(docs)
    lost = removals(docs, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, left = [], []
            for text, x in zip(batch.column(1).cast(pa.binary()), batch.column(2), strict=True):
                data = text.as_py()
                rest, runs = kept(data, [(s["a"], s["b"]) for s in x.as_py() or ()])
                out.append((len(data), len(data) - len(rest), runs, hashlib.sha256(rest).hexdigest()))
                left.append(rest if texts else b"")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 4, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(left, pa.binary())] * texts, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + texts])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    joined = docs.join(lost.withColumnsRenamed({"doc": "_doc", "th": "_th"}), (F.col("doc") == F.col("_doc")) & (F.col("th") == F.col("_th")), "left")
    return joined.select("doc", "text", "spans").mapInArrow(run, schema)
