"""Language identification: script ranges, then Viterbi over per-word scores.

A word's script leaves the languages that are written in it; character n-grams, hashed into
fixed tables that are counted on labelled documents, score it under each. Viterbi with a
penalty for switching labels the words of a document, so mixed texts fall into spans; the
prediction is the language of most letters. A path that never switches is provably best when
no other language gains more than half a penalty over any run of words, which a running
minimum shows for most documents; the others go through the full recursion.

The tables are fitted on at most ``per_language`` labelled documents of each language, taken
by a hash of doc_id, whole texts each. Everything else covers all documents.

Edge cases: null text, or text without a letter, is ``und`` with score 0; without any learned
language everything is; a row
with null doc_id is predicted (held_out false) but never learned from; repeated rows, ties
(the smaller language name), very long texts and other columns need no care. The score is the
share of all letters that stand in words which speak for the language: words in scripts that no
learned language uses count for none, so a text of such words alone has score 0.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

BITS, PER_LANGUAGE, PENALTY, FLOOR = 16, 1500, 12.0, 3.0
BUCKETS, _MIX = 1 << BITS, np.uint64(0x9E3779B97F4A7C15)
_MOST_CACHED = 200_000

# First code points of Unicode ranges and their scripts ("" stands for none of these).
SCRIPTS = [
    (0x0000, "Latin"), (0x0250, ""), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, ""), (0x0750, "Arabic"), (0x0780, ""), (0x0900, "Devanagari"), (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, ""), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, ""), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1380, ""), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, ""),
    (0x3040, "Kana"), (0x3100, ""), (0x3400, "Han"), (0xA000, ""), (0xAC00, "Hangul"), (0xD7B0, ""), (0xF900, "Han"), (0xFB00, ""), (0x20000, "Han"), (0x32000, ""),
]
_STARTS = [a for a, _ in SCRIPTS]
NAMES = sorted({s for _, s in SCRIPTS})


def script(letter: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(letter)) - 1][1]


def letters(chunk: str) -> str:
    """The chunk in lower case without what stands before its first and behind its last letter."""
    low = chunk.lower()
    if low.isalpha():
        return low
    low = low.replace("\x02", "").replace("\x03", "")  # the edges of words in ``grams``
    at = [i for i, c in enumerate(low) if c.isalpha()]
    return low[at[0] : at[-1] + 1] if at else ""


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of the words' character n-grams, 2 to 4 long with a word's edges."""
    marked = "".join([f"\x02{w}\x03" for w in words])
    c = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.cumsum(c == 2) - 1
    h, buckets, numbers = c * _MIX, [], []
    for n in (2, 3, 4):
        h = (h[:-1] * _MIX) ^ c[n - 1 :]
        inside = of[: len(h)] == of[n - 1 :]
        buckets.append(((h[inside] * _MIX) >> np.uint64(64 - BITS)).astype(np.int64))
        numbers.append(of[: len(h)][inside])
    return np.concatenate(buckets), np.concatenate(numbers)


def counts(docs: DataFrame) -> DataFrame:
    """(lang, bucket, n) over (lang, text); bucket -1-i counts words whose script is NAMES[i]."""

    def rows(found: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, table in found.items():
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(table[at])], ["lang", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in found and len(found) == 64:
                    yield from rows(found)
                    found.clear()
                table = found.setdefault(lang, np.zeros(BUCKETS + len(NAMES), np.int64))
                words = [w for w in map(letters, (text or "").split()) if w]
                if words:
                    table[:BUCKETS] += np.bincount(grams(words)[0], minlength=BUCKETS)
                    for name, n in Counter(script(w[0]) for w in words).items():
                        table[BUCKETS + NAMES.index(name)] += n
        yield from rows(found)

    return docs.select("lang", "text").mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Scores of words under each language; words are cached for a worker's life."""

    def __init__(self, langs: list[str], logs: np.ndarray, scripts: dict[str, np.ndarray]):
        self.langs, self.logs, self.scripts = langs, logs, scripts
        self.none = np.zeros(len(langs), bool)

    def start(self) -> None:
        """An empty cache: chunk to row of ``rows``, 0 for letters that say nothing, -1 for no letter."""
        self.rows, self.used, self.index = np.zeros((1 << 12, len(self.langs)), np.float32), 1, {}

    def meet(self, chunks: set[str]) -> None:
        """Score chunks that are not in the cache: at most 0, best candidate 0."""
        words = {c: letters(c) for c in chunks if c not in self.index}
        fresh = sorted({w for w in words.values() if w and w not in self.index})
        if fresh:
            allowed = np.array([self.scripts.get(script(w[0]), self.none) for w in fresh])
            buckets, number = grams(fresh)
            order = np.argsort(number, kind="stable")
            starts = np.searchsorted(number[order], np.arange(len(fresh)))
            logs = self.logs[buckets[order]]
            size = np.diff(np.append(starts, len(order)))
            mean = np.add.reduceat(logs, starts, axis=0) / size[:, None]
            s = np.where(allowed, mean * np.minimum([len(w) for w in fresh], 8)[:, None], -np.inf)
            says = allowed.any(axis=1)
            best = np.where(says, s.max(axis=1), 0)
            while self.used + len(fresh) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[self.used : self.used + len(fresh)] = np.maximum(s - best[:, None], -FLOOR)
            self.index.update(zip(fresh, np.where(says, np.arange(self.used, self.used + len(fresh)), 0).tolist(), strict=True))
            self.used += len(fresh)
        for c, w in words.items():
            self.index[c] = self.index[w] if w else -1

    def label(self, text: str | None) -> tuple[str, float, list[tuple[int, int, str]]]:
        """(language, share of letters in it, spans as (first word, end word, language))."""
        if len(self.index) > _MOST_CACHED:
            self.start()
        chunks = (text or "").split()
        if not self.langs:
            return "und", 0.0, []
        self.meet(set(chunks))
        ids = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        has = ids >= 0
        if not has.any():
            return "und", 0.0, []
        s = self.rows[ids * has]
        path = viterbi(s, PENALTY)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks)) * has
        total = np.bincount(path, weights=size * (ids > 0), minlength=len(self.langs))
        best = int(total.argmax())
        edges = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        return self.langs[best], float(total[best] / size.sum()), [(a, b, self.langs[path[a]]) for a, b in zip(edges, edges[1:], strict=False)]


def viterbi(s: np.ndarray, penalty: float) -> np.ndarray:
    """The best labels of rows s (words by languages) where each switch costs ``penalty``."""
    best = int(s.sum(axis=0).argmax())
    gain = np.cumsum(s - s[:, best : best + 1], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.vstack([np.zeros((1, s.shape[1])), gain[:-1]]), axis=0)
    if (gain - low).max() <= penalty / 2:
        return np.full(len(s), best)
    value, back = s[0].tolist(), []
    for row in s[1:].tolist():
        top = max(value)
        frm, jump = value.index(top), top - penalty
        step = [k if v >= jump else frm for k, v in enumerate(value)]
        value = [(v if v >= jump else jump) + x for v, x in zip(value, row, strict=True)]
        back.append(step)
    path = [value.index(max(value))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1])


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, most_languages: int = 1000) -> Model:
    """Learn from (doc_id, lang, text), at most about ``per_language`` documents of each language.

    The model holds ``BUCKETS`` numbers a language; more than ``most_languages`` of them, as dirty
    labels would give, are an error.
    """
    n_languages = labelled.agg(F.countDistinct("lang")).first()[0]
    if n_languages > most_languages:
        raise ValueError(f"{n_languages} languages to learn; at most {most_languages}: clean the labels or raise most_languages")
    have = {r[0]: r[1] for r in labelled.groupBy("lang").count().orderBy("lang").collect()}
    share = F.create_map(*[F.lit(x) for k, n in have.items() for x in (k, min(1.0, per_language / n))]) if have else None
    found: dict[str, dict[int, int]] = {k: {} for k in have}
    if have:
        drawn = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)
        for lang, bucket, n in counts(labelled.where(drawn)).collect():  # at most languages x BUCKETS
            found[lang][bucket] = n
    langs = sorted(found)
    table = np.zeros((BUCKETS + len(NAMES), len(langs)))
    for i, lang in enumerate(langs):
        for bucket, n in found[lang].items():
            table[bucket, i] = n
    ngrams, words = table[:BUCKETS], table[BUCKETS:]
    logs = np.log((ngrams + 0.5) / (ngrams.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32)
    used = words >= 0.01 * np.maximum(1, words.sum(axis=0))
    return Model(langs, logs, {s: used[i] for i, s in enumerate(NAMES) if s})


def identify(docs: DataFrame, model: Model, spans: bool = False) -> DataFrame:
    """Per row of (doc_id, text): lang_pred, score and, if asked for, spans of words."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logs, model.scripts))  # languages x BUCKETS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        own.start()
        for batch in batches:
            out = [own.label(t.as_py()) for t in batch.column(1)]
            columns = [batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64())]
            if spans:
                columns.append(pa.array([[{"first": a, "end": b, "lang": x} for a, b, x in o[2]] for o in out], pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "spans"][: len(columns)])

    schema = "doc_id long, lang_pred string, score double" + ", spans array<struct<first: long, end: long, lang: string>>" * spans
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def learned(docs: DataFrame) -> DataFrame:
    """The rows that a model may learn from."""
    return docs.select("doc_id", "lang", "text").where(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull())


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs``, whole, that have a language holding at least ``least`` of their letters."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logs, model.scripts))  # languages x BUCKETS floats
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        own.start()
        for batch in batches:
            found = [own.label(t.as_py()) for t in batch.column(at)]
            yield batch.filter(pa.array([x[0] != "und" and x[1] >= least for x in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
