import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from terracell.llm import ann, embedding_dedup, html_extract, langid, line_dedup, mixing, packing, queries, simhash, suffix_dedup, url_filter
from terracell.llm.common import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, component_id int, piece string, h long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts):
    """Rows with odd ids, sources and clashing extra columns."""
    return spark.createDataFrame([(i, t, "en" if i % 2 else "de", f"s{i % 3}" if i % 4 else None, len(t or ""), 7, "x", 1) for i, t in texts], DOCS)


def sample_texts(seed=1, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(200)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = text(40)
    out = [(i, text(rng.randint(0, 60)) + (" " + shared if i % 5 == 0 else "") + ("\n" + text(5) if i % 3 else "")) for i in range(n)]
    return [*out, (n, None), (n + 1, ""), (n + 2, out[3][1]), (n + 3, out[3][1][:-2]), (n + 4, " \t\n"), (n + 5, "a" * 3000), (n + 6, "a" * 2990), (n + 7, "É\u0000 x " * 30), (0, out[0][1])]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, sample_texts())


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (105, 101), (7, 7)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 105: 100}


def test_token_ids_of_odd_texts():
    from tokenizers import Tokenizer

    path, rng = queries.tokenizer_path(), random.Random(7)
    t, e = Tokenizer.from_file(path), packing.Encoder(path)
    parts = [*map(chr, range(256)), *"aZ.,'!", *" \n\t" * 8, "'s", "'LL", "the", "That", "***", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", "\u0130", "\u03a3", "e\u0301", "\u2019", "\u4e2d", "\u2028", "\U0001f600"]
    for k in range(3000):
        text = "".join(rng.choice(parts if k % 2 else parts[:-11]) for _ in range(rng.randint(1, 30)))
        assert np.frombuffer(e.ids(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, ascii(text)


def test_words_are_merged_once(monkeypatch):
    merged = Counter()

    class Encoder(packing.Encoder):
        def __missing__(self, chunk):
            merged[chunk] += chunk not in getattr(self, "older", ())
            return super().__missing__(chunk)

    e = Encoder(queries.tokenizer_path())
    assert e.ids("Word word, WORD. (word) word*** wOrd!") and sum("word" in ascii(c).lower() for c in merged) == 1
    merged.clear()
    monkeypatch.setattr(packing, "_MOST_CACHED", 20)
    for k in range(200):  # a word that keeps coming stays
        e.ids(f"often {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uv'[k // 100]}")
    assert sum(n for c, n in merged.items() if c in ("often", b"often")) == 1


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    t = Tokenizer.from_file(path)
    rows = packing.pack(docs, path, 64).collect()
    want = Counter()
    for i, text in sample_texts():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) <= -(-sum(r.length for r in rows) // 64) + 2
    assert packing.pack(empty, path, 64).count() == 0


def test_bin_completion_uses_all_and_is_tight():
    rng = random.Random(3)
    for hi in (30, 100):
        h = Counter(rng.randint(1, hi) for _ in range(500))
        found = packing.patterns(h, 100)
        used = Counter()
        for times, items in found:
            assert sum(n * c for n, c in items) <= 100
            for n, c in items:
                used[n] += times * c
        assert used == h
        assert packing.gap(h, found, 100) <= 3 + hi // 10
        assert sum(t for t, _ in found) <= -(-sum(n * c for n, c in h.items()) // 100) + 3 + hi // 10


def test_fillings_are_as_full_as_any():
    rng = random.Random(4)
    for _ in range(60):
        left = Counter(rng.randint(3, 30) for _ in range(7))
        lengths = sorted(left)
        best = max(sum(p) for k in range(8) for p in itertools.combinations(list(left.elements()), k) if sum(p) <= 40)
        found = packing.complete(40, lengths, left)
        assert sum(x * n for x, n in found) == best and all(n <= left[x] for x, n in found)


def test_mixing(spark, docs, empty):
    rows = mixing.mix(docs).collect()
    again = Counter(map(tuple, mixing.mix(docs.repartition(3)).collect()))
    assert Counter(map(tuple, rows)) == again
    sizes = Counter((i, len(WORD.findall(t or ""))) for i, t in sample_texts())
    assert Counter((r.doc_id, r["size"]) for r in rows) == sizes
    assert all(r.taken <= 3 * r["size"] for r in rows)
    source = {i: f"s{i % 3}" if i % 4 else None for i, _ in sample_texts()}
    taken, target = Counter(), {}
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] + 5 for s in target)
    assert mixing.mix(empty).count() == 0


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets one source at a time: the one furthest above its limit stops first."""
    left, out = dict(enumerate(sizes)), {}
    while left:
        unit = (sum(sizes) - sum(out.values())) / sum(weights[k % 3] for k in left)
        over = [k for k in left if unit * weights[k % 3] > most * left[k]]
        if not over:
            return out | {k: unit * weights[k % 3] for k in left}
        k = max(over, key=lambda k: unit * weights[k % 3] / max(1e-9, left[k]))
        out[k] = most * left.pop(k)
    return out


@pytest.mark.parametrize("sizes", [[10, 100, 1000], [0], [5], [0, 0, 7], [1, 1000, 2, 50, 3, 9, 100, 100000], [0, 0], []])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(k, f"s{k}", n) for k, n in enumerate(sizes)], "k long, source string, size long")
    got = {r.k: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(shares(sizes))


def test_sources_are_numbered_by_code_point(spark):
    names = ["b", "a", None, "é", "Z", "", "\U0001f600", "\uffee"]
    got = {r.source: r.k for r in mixing.numbered(spark.createDataFrame([(x, 1) for x in names], "source string, size long")).collect()}
    assert got == {x: k for k, x in enumerate([*sorted(x for x in names if x is not None), None])}


@pytest.mark.parametrize("slots", [1, 700, 5_000_000_000_000])
def test_shard_counts_are_a_multinomial_draw(slots):
    """The tree gives every shard its own part of the slots, in any range, and counts vary as they should."""
    whole = list(mixing.shard_counts(slots, 64, 5, 2, 0, 64))
    assert sum(n for _, _, n in whole) == slots
    assert [b for _, b, _ in whole] == list(itertools.accumulate((n for _, _, n in whole), initial=0))[:-1]
    assert [x for a in range(0, 64, 16) for x in mixing.shard_counts(slots, 64, 5, 2, a, a + 16)] == whole
    if slots > 64:
        by = dict((s, n) for s, _, n in whole)
        chi = sum((by.get(s, 0) - slots / 64) ** 2 / (slots / 64) for s in range(64))
        assert 25 < chi < 115  # 63 degrees of freedom


def test_taken_words_follow_the_slots(spark):
    """What documents give is what the slots' blocks hold, block by block."""
    sizes = [(i, f"s{i % 3}", i * 7 % 50) for i in range(200)] + [(5, "s2", 35)] * 3
    sized = spark.createDataFrame(sizes, "doc_id long, source string, size long")
    placed, slots_, taken = mixing.mixed(sized, block_words=8, shard_slots=32)
    words = {}  # of each source: the document of every word, in place
    for r in placed.collect():
        words.setdefault(r.k, {}).update({r.begin + i: (r.begin, r.doc_id) for i in range(r["size"])})
    assert all(sorted(w) == list(range(len(w))) for w in words.values())
    totals = Counter()
    for _, s, n in sizes:
        totals[s] += n
    per = {k: max(1, min(8, totals[f"s{k}"] // 64)) for k in range(3)}
    want = Counter()
    for r in slots_.collect():
        for w in range(r.block * per[r.k], min(len(words[r.k]), (r.block + 1) * per[r.k])):
            want[r.k, words[r.k][w][0]] += 1
    got = Counter()
    for r in taken.collect():
        got[r.k, r.begin] += (r.to_word - r.from_word) * r.times
    assert got == want


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, (1, 2))) == list(range(n))


def test_mixed_texts_hold_what_is_taken(docs):
    rows = mixing.mix(docs).collect()
    texts = mixing.mix_texts(docs)
    assert texts.columns == docs.columns
    texts = texts.collect()
    assert all(r.n_chars == len(r.text) for r in texts)
    words = sum(len(WORD.findall(r.text)) for r in texts)
    assert abs(words - sum(r.taken for r in rows)) <= 0.02 * words


def test_mixed_texts_of_repeated_rows(spark):
    """No row gives more than three times its words, be it repeated or not."""
    text = " ".join(f"w{i}" for i in range(100))
    rows = spark.createDataFrame([(1, text, "a", 0, 0)] * 4 + [(2, text, "b", 0, 0), (3, None, "b", 0, 0), (None, text, None, 0, 0)], "doc_id long, text string, source string, _row long, _copies long")
    out = mixing.mix_texts(rows).collect()
    given_ = Counter()
    for r in out:
        given_[r.doc_id] += len(WORD.findall(r.text))
    assert 0 < given_[1] <= 1200 and given_[2] <= 300 and given_[None] <= 300 and 3 not in given_


def brute_fingerprint(text, n=3):
    w = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    runs = [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(docs, empty):
    got = {r.doc_id: (r.fp & (1 << 64) - 1, r.component_id) for r in simhash.groups(docs).collect()}
    fp = {i: brute_fingerprint(t) for i, t in sample_texts()}
    root = {i: i for i in fp}
    for _ in fp:
        for a, b in itertools.combinations(sorted(fp), 2):
            if (fp[a] ^ fp[b]).bit_count() <= 2:
                root[a] = root[b] = min(root[a], root[b])
    assert got == {i: (fp[i], root[i]) for i in fp}
    assert simhash.groups(empty).count() == 0


def test_links_reach_every_pair_within_two_bits(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, 3))) for b in base for _ in range(8)})
    x = np.array(fps, np.uint64)
    rows = list(zip(x.view(np.int64).tolist(), simhash.popcounts(x).view(np.int64).tolist(), strict=True))
    got = {r.node: r.component for r in components(simhash.links(spark.createDataFrame(rows, "fp long, cell long"))).collect()}
    for (a, fa), (b, fb) in itertools.combinations(zip(fps, x.view(np.int64).tolist(), strict=True), 2):
        if (a ^ b).bit_count() <= 2:
            assert got[fa] == got[fb]


def test_similar_documents(spark):
    rng = random.Random(9)
    text = [" ".join(f"w{rng.randrange(9999)}" for _ in range(200)) for _ in range(5)]
    near = [t.replace(t.split()[50], "other") for t in text]
    rows = [*enumerate(text), *((10 + i, t) for i, t in enumerate(near)), (20, None), (21, ""), (0, text[0]), (None, "x")]
    frame = documents(spark, [(i if i is not None else 0, t) for i, t in rows[:-1]])
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(frame).collect()}
    assert got == {i: i % 10 for i in [*range(5), *range(10, 15)]} | {20: 20, 21: 20}
    assert sorted(r.doc_id for r in simhash.first_of_each(frame).collect()) == [0, 1, 2, 3, 4, 20]


def groups_by_jaccard(texts):
    """The smallest number reachable from each text by links of similarity 0.8 of five words, by all pairs."""
    sets = [set(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    root = list(range(len(texts)))
    pairs = [(a, b) for a, b in itertools.combinations(root, 2) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in range(len(texts)):
        if not [1 for a, b in pairs if root[a] != root[b]]:
            break
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    return root


def family(rng, bases, copies, share):
    word = lambda: f"w{rng.randrange(9999)}"
    for _ in range(bases):
        base = [word() for _ in range(rng.choice((30, 60, 120)))]
        for _ in range(copies):
            own = list(base)
            for k in rng.sample(range(len(own)), rng.randint(1, max(1, len(own) // share))):
                own[k] = word()
            yield " ".join(own + [word() for _ in range(rng.randint(0, len(own) // 20))])


@pytest.mark.parametrize("tiles", [False, True])
def test_similar_documents_by_whole_sets(spark, monkeypatch, tiles):
    """Short texts of a few templates, many near the threshold: groups are those of exact similarity,
    whether those that meet are compared as pairs or block by block."""
    if tiles:
        for name, value in {"FEW": 2, "TILE": 7, "TILE_SHINGLES": 500, "STRIP": 64}.items():
            monkeypatch.setattr(simhash, name, value)
    texts = list(family(random.Random(21), 6, 25, 30))
    root = groups_by_jaccard(texts)
    assert 6 < len(set(root)) < len(root)
    got = {r.doc_id: r.component_id for r in simhash.similar_groups(documents(spark, enumerate(texts))).collect()}
    assert got == dict(enumerate(root))


def test_joined_sets():
    """One tile joins what all pairs of different parts join, over any strips of columns."""
    rng = random.Random(5)
    texts = [*family(rng, 3, 30, 15), "one", "one two", ""]
    sets = [simhash.shingle_set(t.encode(), 5, 42) for t in texts]
    root = groups_by_jaccard([t + " ." * 4 if len(t.split()) < 5 and t else t for t in texts])
    for strip in (16, 4096):
        simhash.STRIP, before = strip, simhash.STRIP
        try:
            assert simhash.joined(sets[:-1], np.arange(len(sets) - 1), 0.8).tolist() == root[:-1]
            assert simhash.joined(sets[:-1], np.zeros(len(sets) - 1), 0.8).tolist() == list(range(len(sets) - 1))
        finally:
            simhash.STRIP = before


def test_language_id(spark, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = queries.op10_language_id(spark, "/root/testdata/sf0.01").join(table.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = found.agg(F.count_if(F.col("lang_pred") == F.col("lang")), F.count("*")).first()
    assert right >= 0.97 * n
    model = langid.fit(langid.learned(table))
    odd = documents(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "the and of the " * 5000), (5, "Привет мир"), (6, "a\x02b \x03")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "en" and all(0 <= s <= 1 for _, s in got.values())
    assert got[5][0] in model.langs and got[5][1] == 0.0  # no learned language is written so
    assert langid.accepted(documents(spark, [(1, "Привет мир"), (2, "the end of the day and of the week")]), model, 0.4).select("doc_id").collect() == [(2,)]
    with pytest.raises(ValueError, match="languages"):
        langid.fit(langid.learned(table), most_languages=2)
    assert langid.identify(odd, langid.fit(langid.learned(empty))).where("lang_pred <> 'und'").count() == 0


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(2)
    for _ in range(30):
        s = -rng.random((6, 3)) * 3
        worth = lambda p, s=s: sum(s[i, k] for i, k in enumerate(p)) - 1.5 * sum(a != b for a, b in itertools.pairwise(p))
        best = max(worth(p) for p in itertools.product(range(3), repeat=6))
        assert worth(langid.viterbi(s, 1.5).tolist()) == pytest.approx(best)


def test_line_dedup(spark, empty):
    rng = random.Random(7)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12))
    rows = [(i, f"{own()}\nLicensed under version {i}.0 of this\n{own()}") for i in range(12)]
    rows += [(50, "Licensed under version 3 of this"), (51, None), (52, ""), (53, "a\n\nb")]
    got = {r.doc_id: r for r in line_dedup.report(documents(spark, rows), min_docs=10, most_share=0.5).collect()}
    assert all(got[i].n_dropped == 1 and "Licensed" not in got[i].text for i in range(12))
    assert got[50].n_dropped == 0 and got[51].text is None and got[52].text == "" and got[53].text == "a\n\nb"
    assert line_dedup.report(empty).count() == 0
    assert line_dedup.clean(documents(spark, rows)).columns == empty.columns


def test_line_dedup_cleans_documents_of_mostly_boilerplate(spark):
    rng = random.Random(17)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(12))
    licence = "All of this may be copied and changed by all who say where it is from and keep this line"
    rows = [(i, f"{own()}\n{own()}\n{licence}") for i in range(12)]
    rows += [(20, f"short text of its own\n{licence}"), (21, licence)]
    text = f"{own()}\n{own()}"
    rows += [(30 + i, text) for i in range(15)]  # copies of one text: for near-dedup
    got = {r.doc_id: r for r in line_dedup.report(documents(spark, rows)).collect()}
    assert got[20].text == "short text of its own" and got[21].text == licence
    assert all(got[i].n_dropped == 1 for i in range(12))
    assert all(got[30 + i].text == text for i in range(15))


def test_line_templates_count_documents_not_forms(spark):
    names = iter([a + b for a in "bcdfghklmn" for b in ("anana", "erry", "lum", "ear")])
    line = lambda: f"The price of {next(names)} in our market is good today"
    filler = lambda i: "\n".join(" ".join(f"{chr(97 + i % 26)}{chr(97 + k)}{chr(97 + j)}" for j in range(12)) for k in range(12))
    one = [(1, filler(1) + "\n" + "\n".join(line() for _ in range(10)))]
    five = [(2 + i, filler(2 + i) + f"\n{line()}\n{line()}") for i in range(5)]
    got = line_dedup.report(documents(spark, one + five), min_docs=10).collect()
    assert {r.doc_id: r.n_dropped for r in got} == dict.fromkeys(range(1, 7), 0)
    more = [(10 + i, filler(8 + i) + f"\n{line()}") for i in range(4)]
    got = line_dedup.report(documents(spark, one + five + more), min_docs=10).collect()
    assert {r.doc_id: r.n_dropped for r in got} == {1: 10} | dict.fromkeys(range(2, 7), 2) | dict.fromkeys(range(10, 14), 1)


def brute_lines(rows, min_docs, leading=3, constant=0.7):
    """What is left of each text, by counting documents of every form, token and template outright."""
    first = {}
    for i, t in rows:
        if t is not None and i is not None:
            first[t] = min(i, first.get(t, i))
    forms, of = defaultdict(set), {}
    for t, i in first.items():
        for line in t.split("\n"):
            if tokens := tuple(line_dedup.masked(line)):
                leaf = (len(tokens), tokens[:leading])
                forms[tokens].add(i)
                of[tokens] = leaf
    at, found = defaultdict(set), defaultdict(set)
    for tokens, ids in forms.items():
        for k, token in enumerate(tokens):
            if token != line_dedup.ANY:
                at[of[tokens], k, token] |= ids
    template = {}
    for tokens, ids in forms.items():
        kept = tuple((k, x) for k, x in enumerate(tokens) if x != line_dedup.ANY and len(at[of[tokens], k, x]) >= min_docs)
        if len(kept) >= constant * len(tokens):
            template[tokens] = (of[tokens], kept)
            found[template[tokens]] |= ids
    again = {f for f, ids in forms.items() if len(ids) >= min_docs or (f in template and len(found[template[f]]) >= min_docs)}
    out = Counter()
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        own = [x for x in lines if tuple(line_dedup.masked(x)) not in again]
        whole = not any(x.split() for x in own)  # no line of its own: left as it is
        out[i, None if t is None else "\n".join(lines if whole else own)] += 1
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_against_counts(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh")
    stems = [[word() * 2 for _ in range(rng.randint(1, 8))] for _ in range(12)]

    def line():
        tokens = list(rng.choice(stems))
        for k in range(len(tokens)):
            if rng.random() < 0.12:
                tokens[k] = rng.choice((word(), "7", "http://x"))
        return " ".join(tokens)

    rows = [(i, "\n".join(line() for _ in range(rng.randint(1, 4))) + rng.choice(("", "\n", f"\nown {i} {word()} {word()} {word()}"))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "\n \n"), *rows[:5], *((300 + i, rows[3][1]) for i in range(9))]
    got = Counter((r.doc_id, r.text) for r in line_dedup.report(documents(spark, rows), min_docs=6).collect())
    want = brute_lines(rows, 6)
    assert got == want
    assert sum(n for (i, t), n in want.items() if (i, t) not in rows) > 20  # many lose lines


def vectors(spark, seed=4, n=300, dim=16):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    x[50:90] = x[0] + 0.02 * rng.standard_normal((40, dim)).astype(np.float32)
    x[100:105] = x[1]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, [0.0] * dim), (1002, [1.0, None] + [0.0] * (dim - 2)), (1003, [float("nan")] + [1.0] * (dim - 1)), (1020, [1.0, 2.0])]
    return spark.createDataFrame([(*r, 3) for r in rows + odd], "vec_id long, embedding array<float>, rank int"), x.astype(np.float64)


def test_neighbours(spark):
    frame, x = vectors(spark)
    got = defaultdict(list)
    for r in ann.search(frame, F.col("vec_id") % 20 == 0, 20).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 300, 20))  # 1020 has no candidate of its dimension
    for q, found in got.items():
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:20]
        assert [v for _, v, _ in sorted(found)] == order
        assert all(abs(score - s[v]) < 1e-9 for _, v, score in found)
    assert ann.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_embedding_dedup(spark):
    frame, x = vectors(spark)
    z = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = (z @ z.T >= 0.9) & ~np.eye(300, dtype=bool)
    got = {r.vec_id: r for r in embedding_dedup.dedup(frame).collect()}
    assert len(got) == 305
    assert sum(got[i].n_links for i in range(300)) >= 0.9 * hit.sum()
    assert all(got[i].n_links <= hit[i].sum() for i in range(300))
    assert {got[i].component_id for i in range(50, 90)} == {0} and got[104].component_id == 1
    assert all(got[i].n_links == 0 and got[i].kept for i in (1000, 1001, 1002, 1003, 1020))
    assert embedding_dedup.dedup(frame.limit(0)).count() == 0


def test_embedding_dedup_links_dense_clusters(spark):
    """Each side has more near vectors than a list holds, so no list has a link over the gap."""
    rng = np.random.default_rng(12)
    centres = np.eye(24)[[0, 0]]
    centres[1] = 0.93 * np.eye(24)[0] + np.sqrt(1 - 0.93**2) * np.eye(24)[1]
    x = (np.repeat(centres, 150, axis=0) + 0.005 * rng.standard_normal((300, 24))).astype(np.float32)
    z = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    hit = (z @ z.T >= 0.9) & ~np.eye(300, dtype=bool)
    assert hit[:150, 150:].mean() > 0.5
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embedding_dedup.dedup(rows).collect()}
    assert [got[i].n_links for i in range(300)] == hit.sum(axis=1).tolist()
    assert {r.component_id for r in got.values()} == {0} and [i for i in got if got[i].kept] == [0]


def exact_groups(x, threshold=0.9):
    z = x / np.abs(x).max(axis=1, keepdims=True)
    z = z / np.linalg.norm(z, axis=1, keepdims=True)
    hit = (z @ z.T >= threshold) & ~np.eye(len(x), dtype=bool)
    root = np.arange(len(x))
    while True:
        now = np.minimum(root, np.where(hit, root, len(x)).min(axis=1))
        if (now == root).all():
            return hit.sum(axis=1).tolist(), root.tolist()
        root = now


def test_embedding_dedup_in_double_precision(spark):
    """Differences that single precision cannot hold decide links and equality."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 6))
    x[10:20] = x[0] + 1e-12 * rng.standard_normal((10, 6))  # equal as floats
    x[20] = 1e-300 * x[1]
    x[21] = 1e300 * x[1]
    x[22] = 0.0
    x[22, :2] = (0.9, np.sqrt(1 - 0.9**2) * (1 + 1e-9))  # just below 0.9 with the next
    x[23] = np.eye(6)[0]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(100, [5e-324, 0.0]), (101, [1.0, 0.0]), (102, None)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.dedup(rows).collect()}
    links, root = exact_groups(x)
    assert got == dict(enumerate(zip(links, root, strict=True))) | {100: (1, 100), 101: (1, 100), 102: (0, 102)}


def test_embedding_dedup_falls_back_on_every_pair(spark, monkeypatch):
    """Where lists find nothing and the audit keeps saying so, all nodes are compared."""
    monkeypatch.setattr(embedding_dedup, "sorted_runs", lambda v, *_: v.select(F.col("id").alias("u"), F.col("id").alias("v"), F.lit(-1.0).alias("cos")).where("false"))
    frame, x = vectors(spark)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.dedup(frame, most_rounds=2).collect()}
    links, root = exact_groups(x)
    assert [got[i] for i in range(300)] == list(zip(links, root, strict=True))


def test_forest_finds_connected_parts():
    hit = np.zeros((5, 5), bool)
    hit[[0, 1, 1, 2, 3], [1, 1, 3, 3, 0]] = True
    assert [(f, sorted(r.tolist()), sorted(c.tolist())) for f, r, c in embedding_dedup.forest(hit)] == [(0, [0, 1, 2], [1, 3]), (3, [3], [0])]


def test_html(spark):
    page = "<body><nav><ul><li><a href=/x>Home</a></ul></nav><article><h1>T &amp; t</h1><p>Some \n text<p><b>more&nbsp;text<br><p>end</article><div class='comments'><p>I say</p></div><form>f</form><script>var a='<p>x</p>'</script><footer>&copy; x</footer>"
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", "<!-- open"), (6, "u", "<article>" + "<p>word</p>" * 3000)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert html_extract.extract(table.limit(0)).count() == 0
    got = {r.page_id: r for r in html_extract.extract(table, np.array(html_extract.PRIOR)).collect()}
    assert got[1].text == "T & t\nSome text\nmore text\nend" and got[1].n_chars == len(got[1].text)
    assert [got[i].text for i in (2, 3, 5)] == ["", "", ""] and got[6].text.count("word") == 3000


LONG = "This is a long paragraph of the article with several words in it, as articles have. It goes on for a while, and then it ends."
# pages with the text that people would mark in them
MARKED = [
    (f'<article><div class="entry-header"><h1>Title</h1></div><p>{LONG}</p></article>', f"Title\n{LONG}"),
    (f'<article><p aria-hidden="false">{LONG}</p><p data-role="form">{LONG}</p><p aria-hidden="true">{LONG}</p></article>', f"{LONG}\n{LONG}"),
    (f'<div class="layout sidebar left"><article><p>{LONG}</p></article><p>Menu</p></div>', LONG),
    (f"<form id=f><main><p>{LONG}</p></main><p>Search</p></form>", LONG),
    (f'<header><a href="/">The Site</a></header><div><h1>News</h1><p>{LONG}</p><p>Yes.</p><p>{LONG}</p></div><footer><p>{LONG}</p></footer>', f"News\n{LONG}\nYes.\n{LONG}"),
    (f'<nav><a href="/a">One</a> <a href="/b">Two</a></nav><article><header><h1>T</h1></header><p>{LONG}</p><footer>By me</footer><div id="comments"><article><p>{LONG}</p></article></div></article>', f"T\n{LONG}"),
    (f'<div class="sidebar">{"<p>" + LONG + "</p>"}</div><article><p>{LONG}</p><ul><li>first of all</li><li>second</li></ul></article>', f"{LONG}\nfirst of all\nsecond"),
    (f'<article><p>{LONG}<div class="cookie-notice">{LONG}</div><p>x &lt; y &amp;&nbsp;z<br>end</article>', f"{LONG}\nx < y & z end"),
    (f'<div class="related-posts"><article><p>{LONG}</p></article></div><article><p>{LONG}</p><aside>{LONG}</aside></article>', LONG),
    (f'<main><p>{LONG}</p><script>"<p>"</script><noscript>{LONG}</noscript><button>Go</button><p hidden>{LONG}</p><p style="display: none">{LONG}</p></main>', LONG),
    (f'<div class="sidebar">{"<p>" + LONG + "</p>" * 1}</div>', ""),
    ("<div class=sidebar>" + f"<p>{LONG}</p>" * 12 + "</div>", "\n".join([LONG] * 12)),
    ("<ul><li><a href=/>Home</a><li><a href=/a>About</a></ul>", ""),
]


def test_html_of_marked_pages():
    """Words kept of all that should be, and of all that are: with nothing learned and with weights as pages give them."""
    for weights in (np.array(html_extract.PRIOR), np.array((-0.9, 0.3, -5.8, 0.7, 3.1, -1.3))):
        right = kept = want = 0
        for html, text in MARKED:
            got = Counter(html_extract.main_text(html, weights).split())
            right += (got & Counter(text.split())).total()
            kept, want = kept + got.total(), want + len(text.split())
        assert right >= 0.97 * kept and right >= 0.97 * want
    assert all(html_extract.main_text(html, weights) == text for html, text in MARKED)


def test_html_of_the_pages(spark):
    """All of the article and nothing else on each page of the table, where it is the article element."""
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = html_extract.fit(pages)
    assert weights.tolist() == html_extract.fit(pages.repartition(3)).tolist()
    got = {r.page_id: r.text for r in html_extract.extract(pages, weights).collect()}
    turned = n = 0
    for page in pages.collect():
        parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*?)</article>", page.html, re.S)[1])
        clean = [" ".join(unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " "))).split()) for x in parts]
        assert got[page.page_id] == "\n".join(x for x in clean if x)
        found, parents = html_extract.scan(page.html)
        own, edges = html_extract.graph(found, parents, weights)
        turned += sum((s > 0) != side for s, side in zip(own[: len(found)], html_extract.min_cut(own, edges), strict=False))
        n += len(found)
    assert 0.05 * n < turned < 0.3 * n  # the cut decides against a block's own words


def test_min_cut_against_all_labellings():
    rng = random.Random(8)
    for _ in range(40):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        edges = {i: {} for i in range(n)}
        for i, j in itertools.combinations(range(n), 2):
            if rng.random() < 0.5:
                edges[i][j] = edges[j][i] = rng.uniform(0, 2)
        cost = lambda x, s=scores, e=edges: sum(max(0, -v) if x[i] else max(0, v) for i, v in enumerate(s)) + sum(w for i in e for j, w in e[i].items() if i < j and x[i] != x[j])
        assert cost(html_extract.min_cut(scores, edges)) == pytest.approx(min(map(cost, itertools.product((False, True), repeat=n))))


def brute_removal(rows, n=50):
    out, seen = {}, set()
    for doc, text in sorted(dict(rows).items()):
        data = (text or "").encode()
        gone = bytearray(len(data))
        own = {data[i : i + n] for i in range(len(data) - n + 1)}
        for i in range(len(data) - n + 1):
            if data[i : i + n] in seen:
                gone[i : i + n] = b"\1" * n
        seen |= own
        left = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc] = (len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest())
    return out


def test_suffix_dedup(docs, empty):
    rows = sample_texts()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup(docs).collect()}
    assert got == brute_removal(rows)
    assert suffix_dedup.dedup(empty).count() == 0


def test_only_windows_that_are_met_again_are_sorted(monkeypatch):
    rng, sorted_ = random.Random(9), []
    monkeypatch.setattr(suffix_dedup, "common_prefixes", lambda rows, sizes, f=suffix_dedup.common_prefixes: sorted_.append(len(rows)) or f(rows, sizes))
    for k in range(60):
        ctx = [bytes(rng.choice(b"ab" if k % 3 else b"abcdefgh\0") for _ in range(rng.randint(8, 13))) for _ in range(rng.randint(1, 30))]
        ctx += [x[2:] + b"zz" for x in ctx[: k % 5]]
        docs = [rng.randint(0, 9) for _ in ctx]
        windows = [(d, x[o : o + 8], (r, o)) for r, (d, x) in enumerate(zip(docs, ctx, strict=True)) for o in range(len(x) - 7)]
        want = {(r, i) for d, w, (r, o) in windows for i in range(o, o + 8) if any(e < d and v == w for e, v, _ in windows)}
        times = Counter(w for _, w, _ in windows)
        sorted_.clear()
        column = pa.array([b"skipped", *ctx], pa.binary()).slice(1)
        part = pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(range(len(ctx)), pa.int64()), pa.array([1] * len(ctx), pa.int64()), column, pa.array([0] * len(ctx), pa.int64())], ["doc", "th", "h", "ctx", "begin"])
        got = suffix_dedup.solved(part, 8)
        assert {(r["th"], i) for r in got.to_pylist() for i in range(r["a"], r["b"])} == want
        assert sum(sorted_) == sum(n for n in times.values() if n > 1)


def test_frequent_anchors_go_window_by_window(spark):
    rng = random.Random(6)
    ctx = [(k, k, k % 3, bytes(rng.choice((b"ab", b"cd", b"ef")[k % 3]) for _ in range(rng.randint(10, 14))), 100 * k) for k in range(200)]
    rows = spark.createDataFrame(ctx, "doc long, th long, h long, ctx binary, begin long").withColumn("stop", F.lit(0).cast("long"))
    marks = lambda most: {(r.doc, i) for r in suffix_dedup.close_look(rows, 10, most).collect() for i in range(r.a, r.b)}
    want = set()
    for k, _, h, x, begin in ctx:
        for o in range(len(x) - 9):
            if any(d < k and g == h and x[o : o + 10] in y for d, _, g, y, _ in ctx):
                want |= {(k, begin + i) for i in range(o, o + 10)}
    assert want and marks(10) == marks(10**6) == want


def test_url_filter(spark):
    events = [("spam", "a.example.com", "2024-01-10", "add"), ("spam", "a.example.com", "2024-02-10", "remove"), ("bad", "example.com", "2024-03-01", "add"), ("bad", "b.org/x", "2024-01-01", "add"), (None, "b.org", "2024-01-01", "add"), ("bad", "c.org", "2024-01-05", "add"), ("bad", "c.org", "2024-01-05", "remove")]
    e = spark.createDataFrame(events, "list string, key string, date string, action string").withColumn("date", F.to_date("date"))
    urls = [(1, "http://a.example.com/y", "2024-01-09"), (2, "http://A.example.com/y", "2024-01-10"), (3, "http://a.example.com/", "2024-02-10"), (4, "https://u@a.example.com:80/y", "2024-03-05"), (5, "http://b.org/x/z?q", "2025-01-01"), (6, "http://b.org/y", "2025-01-01"), (7, None, "2024-01-01"), (8, "no url", "2024-01-01"), (9, "http://c.org", None), (10, "http://c.org", "2024-06-01")]
    c = spark.createDataFrame(urls, "id long, url string, fetched string").withColumn("fetched", F.to_date("fetched"))
    got = {r.id: r.lists for r in url_filter.evaluate(c, e).collect()}
    assert got == {1: "", 2: "spam", 3: "", 4: "bad", 5: "bad", 6: "", 7: "", 8: "", 9: "", 10: "bad"}
    assert url_filter.evaluate(c.limit(0), e).count() == 0
    assert url_filter.evaluate(c, e.limit(0)).where("blocked").count() == 0


def test_distant_dates_cost_nothing(spark):
    events = spark.range(300).select(F.lit("spam").alias("list"), F.concat(F.lit("h"), F.col("id"), F.lit(".org")).alias("key"), F.lit("2020-01-01").cast("date").alias("date"), F.lit("add").alias("action"))
    rows = spark.createDataFrame([(1, "http://h7.org/", "9999-12-31"), (2, "http://h7.org/", "0001-01-01"), (3, "http://h8.org/", "2020-01-31")], "id long, url string, fetched string").withColumn("fetched", F.to_date("fetched"))
    assert {r.id: r.blocked for r in url_filter.evaluate(rows, events).collect()} == {1: True, 2: False, 3: True}


def test_pipeline_keeps_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()

CLASHING = DOCS + ", _line long, _Row string, _copies long, _id long, _h long, _n long, _b long, text2 string"


@pytest.mark.parametrize("stage", ["language_id", "line_templates", "near_duplicates", "source_mix"])
def test_stages_keep_odd_tables(spark, stage):
    """Every column comes through, whatever its name; nulls, empty tables and repeated rows pass."""
    import corpus_pipeline

    run = getattr(corpus_pipeline, stage)
    made = documents(spark, [(i, t) for i, t in sample_texts(seed=4, n=30)]).collect()
    more = [(*r, 1, "r", 2, 3, 4, 5, 6, "t") for r in made] + [(None,) * 16, (99, *[None] * 15)]
    rows = spark.createDataFrame([*more, *more[:3]], CLASHING)
    for table in (rows, rows.limit(0)):
        out = run(spark, table, "")
        assert out.schema.simpleString() == rows.schema.simpleString()
        got = out.collect()
        assert all(r._b in (6, None) and r.text2 in ("t", None) for r in got)
    assert not got
    model = spark.createDataFrame([(*r[:2], "en", *r[3:]) for r in more], CLASHING)
    assert run(spark, model, "").columns == rows.columns
