"""Best-fit packing of token sequences by bin completion.

Documents become token ids, are cut into pieces of at most ``capacity`` tokens and the pieces
are packed into sequences. Piece lengths take at most ``capacity`` values, so the search works
on their histogram, whose size does not depend on the number of documents: bin completion
takes the longest length left, branches over the undominated fillings of the space beside it,
prunes by a bound on waste with the best-fit filling as incumbent, and applies the pattern it
finds as often as the counts allow. A filling is undominated if none of its items could give way
to a longer one that is left and fits. Bins are completed one after the other, without
returning to an earlier one; ``gap`` tells how many sequences more than the least possible that
took. Pieces then look up their place by (length, rank).

Edge cases: null or empty text is the end token alone (one piece of length 1); very long texts
are cut; repeated rows are packed each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, running, small_batches

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_MOST_CACHED = 150_000  # of each of two generations
_CONTROLS = re.compile("[\x1c-\x1f]").search
_encoders: dict[str, Encoder] = {}


def _latin_tables() -> tuple[bytes, bytes]:
    """Latin-1 bytes in lower case with white space as blanks; and their kinds: 1 letters, 2 ASCII marks, 0 the rest.

    The apostrophe is no mark, as it begins contractions ('s), nor is a digit a letter: each is a word of its own.
    """
    fold, kind = bytearray(range(256)), bytearray(256)
    for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]:
        fold[c], kind[c] = ord(chr(c).lower()), 1
    for c in [*range(9, 14), 0x85, 0xA0]:
        fold[c] = 32
    for c in b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~':
        kind[c] = 2
    return bytes(fold), bytes(kind)


_FOLD, _KIND = _latin_tables()


class Encoder(dict):
    """Token ids (little-endian uint32 bytes) of a chunk of text, in Latin-1 bytes or, where it goes beyond, as str.

    The tokenizer drops white space and never joins across it, nor between letters and marks, and
    lower-cases; so a Latin-1 text's ids are those of its lower-case words and marks one after the
    other. Words of letters go to the merges directly, all other chunks through the whole
    tokenizer. Chunks are kept for the worker's life in two bounded generations: when the younger
    is full it becomes the older, whose chunks return when they are met again.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.older: dict[bytes | str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.word = re.compile(b"[a-z\xdf-\xf6\xf8-\xff]+").fullmatch
        # byte-level alphabet: printable Latin-1 stands for itself, the other bytes for 256 and on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*own}))}
        self.id = [k.to_bytes(4, "little") for k in range(self.tokenizer.get_vocab_size())]

    def __missing__(self, chunk: bytes | str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self.fresh(chunk)
        if len(self) >= _MOST_CACHED:
            self.older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids

    def fresh(self, chunk: bytes | str) -> bytes:
        if isinstance(chunk, bytes):
            if self.word(chunk):
                letters = chunk.decode() if chunk.isascii() else chunk.decode("latin-1").encode().decode("latin-1").translate(self.alphabet)
                return b"".join([self.id[t.id] for t in self.tokenizer.model.tokenize(letters)])
            chunk = chunk.decode("latin-1")
        elif (parts := self.latin(chunk)) is not None:
            return b"".join(map(self.__getitem__, parts))
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def latin(self, text: str) -> list[bytes] | None:
        """The chunks of a text in Latin-1; none if it goes beyond, or may hold a special token, whose letters and marks are one."""
        try:
            low = text.encode("latin-1").translate(_FOLD)
        except UnicodeEncodeError:
            return None
        if b"<|" in low:
            return None
        kind = np.frombuffer(low.translate(_KIND), np.uint8)
        between = np.flatnonzero((kind[1:] ^ kind[:-1]) == 3)  # letters and marks
        return (np.insert(np.frombuffer(low, np.uint8), between + 1, 32).tobytes() if len(between) else low).split()

    def chunks(self, text: str) -> list[bytes] | list[str]:
        if (parts := self.latin(text)) is not None:
            return parts
        # str.split also cuts at U+001C to U+001F, which the tokenizer keeps
        return text.replace("\n", " ").split(" ") if _CONTROLS(text) else text.split()

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.chunks(text)))


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 1) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens, in document order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path).ids, np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def complete(space: int, lengths: list[int], left: dict[int, int], most_nodes: int = 3000) -> list[tuple[int, int]]:
    """The filling of ``space`` with least waste: (length, copies) from the ascending ``lengths``.

    Depth first from the largest item that fits, with as many copies as fit, never larger than
    the one before it. The first path is best fit; a branch is pruned when all that is left below
    it cannot beat the incumbent's waste, and a filling is passed over if it is dominated: if one
    of its items could give way to a longer one that is not used up and fits the waste. After
    ``most_nodes`` the incumbent stands: a bound on the work, not on what is packed.
    """
    best: list[tuple[int, int]] = []
    waste, nodes = space, 0
    below = [0, *accumulate(left[x] * x for x in lengths)]  # tokens in the first i lengths

    def dominated(room: int, chosen: list[tuple[int, int]]) -> bool:
        used = dict(chosen)
        for x in used:
            at = bisect_right(lengths, x)
            if any(left[y] > used.get(y, 0) for y in lengths[at : bisect_right(lengths, x + room, at)]):
                return True
        return False

    def visit(room: int, top: int, chosen: list[tuple[int, int]]) -> bool:
        nonlocal best, waste, nodes
        if room < waste and not dominated(room, chosen):
            best, waste = chosen, room
        if not waste:
            return True
        for i in range(bisect_right(lengths, room, 0, top) - 1, -1, -1):
            nodes += 1
            if nodes > most_nodes:
                return True
            if room - below[i + 1] >= waste:  # all that is left below cannot beat the incumbent
                return False
            x = lengths[i]
            for copies in range(min(left[x], room // x), 0, -1):
                if visit(room - copies * x, i, [*chosen, (x, copies)]):
                    return True
        return False

    visit(space, len(lengths), [])
    return best


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, copies), ...]) that use up the histogram, longest lengths first."""
    left = {k: n for k, n in histogram.items() if n}
    lengths = sorted(left)
    out = []
    while lengths:
        x = lengths[-1]
        left[x] -= 1
        usable = lengths if left[x] else lengths[:-1]
        filling = complete(capacity - x, usable, left)
        left[x] += 1
        need: dict[int, int] = {x: 1}
        for y, copies in filling:
            need[y] = need.get(y, 0) + copies
        times = min(left[y] // n for y, n in need.items())
        for y, n in need.items():
            left[y] -= times * n
        lengths = [y for y in lengths if left[y]] if any(not left[y] for y in need) else lengths
        out.append((times, sorted(need.items(), reverse=True)))
    return out


def places(found: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, from rank, to rank, copies, first sequence, offset) for each item of each pattern."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, items in found:
        offset = 0
        for length, copies in items:
            at = rank.get(length, 0)
            rows.append((length, at, at + times * copies, copies, sequence, offset))
            rank[length] = at + times * copies
            offset += length * copies
        sequence += times
    return rows


def gap(histogram: dict[int, int], found: list[tuple[int, list[tuple[int, int]]]], capacity: int) -> int:
    """Sequences used beyond a lower bound: all tokens in full sequences, and none shared by two pieces over half."""
    tokens, large = sum(n * c for n, c in histogram.items()), sum(c for n, c in histogram.items() if 2 * n > capacity)
    return sum(t for t, _ in found) - max(-(-tokens // capacity), large)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096) -> DataFrame:
    """Every piece of ``docs`` with its sequence_id and its offset there (gapless from 0)."""
    cutpieces = cut(pieces(docs, tokenizer_path, capacity))
    histogram = {r[0]: r[1] for r in cutpieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    rows = np.array(sorted(places(patterns(histogram, capacity))), np.int64).reshape(-1, 6)  # by length, then rank; a few rows a length
    length, lo, _, copies, base, at = rows.T
    order = [F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")]
    ranked = running(cutpieces, ["length"], order, F.lit(1), "rank", sum(histogram.values()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            begin = np.searchsorted(length, mine)
            found = np.empty(len(mine), np.int64)
            for n in np.unique(mine):  # the last pattern of the length that begins at the rank or before
                own = mine == n
                first, end = np.searchsorted(length, n), np.searchsorted(length, n, "right")
                found[own] = begin[own] + np.searchsorted(lo[first:end], rank[own], "right") - 1
            k = rank - lo[found]
            sequence, offset = base[found] + k // copies[found], at[found] + k % copies[found] * mine
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
