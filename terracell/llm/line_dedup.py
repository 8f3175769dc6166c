"""Line dedup by a log-template tree.

Lines fall down a tree of fixed depth: by their number of tokens, then by their leading tokens,
fields that vary (numbers, dates, addresses, long hex) standing as ``<*>``. In a leaf a token is
constant at its position when at least ``min_docs`` documents have it there; the others become
``<*>`` too. What is left is a line's template, if enough of it is constant; otherwise the masked
line is. Templates found in at least ``min_docs`` documents recur, and their lines are dropped
from all documents. Documents with equal texts count as one, so copying a text makes none of its
lines recur. Only a document with no line of its own is left as it is, if such lines hold more
than ``most_share`` of its words, as all do unless that is 1: there is no text to clean.

All counts are of distinct documents, however many forms of a template one has. Sums over forms,
which combine before the shuffle, bound them from above and the most frequent form from below;
documents are told apart only where the bounds leave it open. Only lines of leaves that enough
documents share are taken apart into tokens.

Edge cases: null text stays null and has no lines; blank lines are never dropped; repeated rows
count as one document for each doc_id; rows without doc_id are cleaned but count for nothing;
very long texts and lines are read whole; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh, small_batches

LEADING, MIN_DOCS, CONSTANT, MOST_SHARE = 3, 10, 0.7, 0.5
ANY = "<*>"
_VARIES = re.compile(r"[0-9@]|://|\bwww\.").search
_HASH = xxhash.xxh64_intdigest


def masked(line: str) -> list[str]:
    tokens = line.split()
    return [ANY if _VARIES(t) else t for t in tokens] if _VARIES(line) else tokens


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def parsed(docs: DataFrame, leading: int) -> DataFrame:
    """(doc_id, h, line, words, leaf, form): each line's leaf and masked form, as hashes; h tells texts apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, lines, leaves, forms = [], [], [], [], []
            for row, text in enumerate(batch.column(2)):
                for k, line in enumerate((text.as_py() or "").split("\n")):
                    if tokens := masked(line):
                        n = len(tokens)
                        rows.append(row)
                        sizes.append(n)
                        lines.append(k)
                        leaves.append(_HASH(f"{n} {' '.join(tokens[:leading])}"))
                        forms.append(_HASH(" ".join(tokens)))
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(lines, pa.int32()), pa.array(sizes, pa.int32()), _signed(leaves), _signed(forms)], ["doc_id", "h", "line", "words", "leaf", "form"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").mapInArrow(run, "doc_id long, h long, line int, words int, leaf long, form long")


def found_in(rows: DataFrame, key: list[str], of: DataFrame, min_docs: int) -> DataFrame:
    """Those ``key`` of (form, docs) rows that at least ``min_docs`` distinct documents have.

    ``of`` has the (form, doc_id) of forms in fewer documents; other forms suffice by themselves.
    """
    bounds = rows.groupBy(*key).agg(F.max("docs").alias("least"), F.sum("docs").alias("most")).where(F.col("most") >= min_docs)
    open_ = rows.join(bounds.where(F.col("least") < min_docs).select(key), key).select(*key, "form").join(of, "form")
    told = open_.groupBy(*key).agg(F.countDistinct("doc_id").alias("n")).where(F.col("n") >= min_docs)
    return bounds.where(F.col("least") >= min_docs).select(key).unionByName(told.select(key))


def recurring(docs: DataFrame, lines: DataFrame, leading: int, min_docs: int, constant: float) -> DataFrame:
    """Masked forms (hashes) whose template at least ``min_docs`` documents of different text have."""
    # of documents with equal texts the one of smallest doc_id counts
    least = docs.where("doc_id is not null").groupBy(F.xxhash64("text").alias("h")).agg(F.min(F.col("doc_id").cast("long")).alias("least"), F.max(F.col("doc_id").cast("long")).alias("most")).where("least <> most")
    copies = least.select("h", "least").withColumnRenamed("h", "_h")
    lines = lines.where("doc_id is not null").join(copies, (F.col("h") == F.col("_h")) & (F.col("doc_id") > F.col("least")), "left_anti")
    seen = lines.groupBy("leaf", "form").agg(F.min(F.struct("doc_id", "h", "line")).alias("one"), F.countDistinct("doc_id").alias("docs"))
    seen = cut(seen)
    shared = seen.groupBy("leaf").agg(F.sum("docs").alias("n"), F.count("*").alias("forms")).where(F.col("n") >= min_docs)
    alike = seen.where(F.col("docs") >= min_docs).select("form")
    # leaves of several forms that enough documents share: take one line of each form apart
    several = seen.join(shared.where("forms > 1").select("leaf"), "leaf")
    wanted = several.select("one.doc_id", "one.h", F.struct("one.line", "leaf", "form", "docs").alias("x")).groupBy("doc_id", "h").agg(F.collect_list("x").alias("wanted"))

    def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, want in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                split = text.as_py().split("\n")
                out += [(w["leaf"], w["form"], w["docs"], masked(split[w["line"]])) for w in want]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 4, kinds, strict=True)], ["leaf", "form", "docs", "tokens"])

    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), "text").where("text is not null").dropDuplicates(["doc_id", "h"])
    forms = cut(texts.join(wanted, ["doc_id", "h"]).select("text", "wanted").mapInArrow(take_apart, "leaf long, form long, docs long, tokens array<string>"))
    tokens = forms.select("leaf", "form", "docs", F.posexplode("tokens").alias("at", "token"))
    of = cut(lines.join(forms.where(F.col("docs") < min_docs).select("form").distinct(), "form").select("form", "doc_id").distinct())
    kept = found_in(tokens.where(F.col("token") != ANY), ["leaf", "at", "token"], of, min_docs)
    constants = tokens.join(kept, ["leaf", "at", "token"]).groupBy("leaf", "form", "docs").agg(F.array_sort(F.collect_list(F.struct("at", "token"))).alias("constant"))
    size = forms.select("leaf", "form", F.size("tokens").alias("size"))
    templates = constants.join(size, ["leaf", "form"]).where(F.size("constant") >= constant * F.col("size")).select("form", "docs", F.xxhash64("leaf", "constant").alias("template"))
    often = found_in(templates, ["template"], of, min_docs)
    return alike.unionByName(templates.join(often, "template").select("form")).distinct()


def dropped_lines(docs: DataFrame, leading: int = LEADING, min_docs: int = MIN_DOCS, constant: float = CONSTANT, most_share: float = MOST_SHARE) -> DataFrame:
    """(doc_id, h, lines): numbers of the lines to drop, for texts that lose any."""
    lines = cut(parsed(docs, leading))
    again = recurring(docs, lines, leading, min_docs, constant)
    hit = lines.join(again, "form").groupBy("doc_id", "h").agg(F.collect_set("line").alias("lines"), F.sum("words").alias("lost"))
    total = lines.groupBy("doc_id", "h").agg(F.sum("words").alias("words"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("doc_id", "h")]
    return hit.alias("a").join(total.alias("b"), same).where((F.col("lost") < F.col("words")) | (F.col("lost") <= most_share * F.col("words"))).select("a.doc_id", "a.h", "lines")


def cleaned(docs: DataFrame, count: str, **options) -> DataFrame:
    """``docs`` with its text rewritten, and struct ``count`` of how many lines it had and lost."""
    lost = dropped_lines(docs, **options)
    out = docs.alias("d").join(lost.alias("l"), F.col("d.doc_id").cast("long").eqNullSafe(F.col("l.doc_id")) & (F.xxhash64("d.text") == F.col("l.h")), "left")
    text = F.when(F.col("l.lines").isNull(), F.col("d.text")).otherwise(F.expr("array_join(filter(split(d.text, '\\n', -1), (x, i) -> not array_contains(l.lines, i)), '\\n')"))
    had = F.when(F.col("d.text").isNull(), 0).otherwise(F.size(F.split("d.text", "\n", -1))).cast("long")
    counts = F.struct(had.alias("had"), F.coalesce(F.size("l.lines"), F.lit(0)).cast("long").alias("lost"))
    return out.select(*[text.alias(c) if c == "text" else F.col(f"d.`{c}`") for c in docs.columns], counts.alias(count))


def clean(docs: DataFrame, **options) -> DataFrame:
    """The documents without their recurring lines; n_chars, if there is one, follows the text."""
    out = cleaned(docs, *fresh(docs, "_line"), **options).select([F.col(f"`{c}`") for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped and the text that is left."""
    return cleaned(docs.select("doc_id", "text"), "_line", **options).select("doc_id", F.col("_line.had").alias("n_lines"), F.col("_line.lost").alias("n_dropped"), "text")
