"""Collocations, spelling variants and byte-wise dedup against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.data import awkward, docs, words
from waymend.llm import byte_dedup, collocations, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ------------------------------------------------------------------ collocations

def plain_collocations(rows, least=10, top=2000, longest=3, share=(50, 100)):
    counts, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            sizes[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    counts[lang or "und", tuple(w[i : i + k])] += 1
    found = []
    for (lang, p), a in counts.items():
        if len(p) < 2 or a < least:
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = counts[lang, p[:k]], counts[lang, p[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        longer = [n for (g, q), n in counts.items() if g == lang and len(q) > len(p) and n >= least
                  and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if not any(share[1] * n >= share[0] * a for n in longer):
            found.append((lang, -score, -a, " ".join(p), l, r))
    out = []
    for lang in {f[0] for f in found}:
        for rank, (_, s, a, p, l, r) in enumerate(sorted(f for f in found if f[0] == lang)[:top], 1):
            out.append((lang, rank, p, -a, l, r, sizes[lang], -s))
    return sorted(out)


COLUMNS11 = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def spoken(rng):
    marks = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", " ! ", "; ", "?:"]
    return "".join(rng.choice("AbcdÉé") + rng.choice(["", "x", " "]) + rng.choice(marks) for _ in range(rng.randrange(60)))


@pytest.mark.parametrize("block_words", [4_000_000, 40])
def test_collocations(spark, block_words):
    rng = random.Random(2)
    rows = [(i, spoken(rng), rng.choice(["en", "en", "de", None, "und"])) for i in range(150)]
    rows += [(1000 + i, t, "en") for i, t in awkward()] + [(7, "one two three. " * 30, "de"), (7, "one two three. " * 30, "de")]
    got = collocations.collocations(docs(spark, rows).repartition(3), block_words=block_words)
    assert got.columns == list(COLUMNS11)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows)


def test_collocations_of_four_words_and_a_short_list(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PART", 50)
    rng = random.Random(3)
    rows = [(i, spoken(rng) + "to be or not to be", None) for i in range(60)]
    got = collocations.collocations(docs(spark, rows), longest=4, least=4, top=7, nested_share=(9, 10))
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows, 4, 7, 4, (9, 10))


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    rng = random.Random(4)
    rows = [(a, a + rng.randrange(a), a + rng.randrange(a)) for a in [rng.randrange(1, 10**k) for k in range(2, 15)] for _ in range(20)]
    rows += [(10**14, 10**14, 10**14), (3, 3, 1_000_003), (99_999_999_999_999, 10**14, 10**14)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [tuple(r) for r in df.select("a", "l", "r", collocations.scored(df.a, df.l, df.r)).collect()]
    assert got == [(a, l, r, 1_000_000 * a * a // (l * r)) for a, l, r in rows]


def test_collocations_defined_cases(spark):
    assert collocations.collocations(docs(spark, [])).count() == 0
    assert collocations.collocations(docs(spark, [(1, None, None), (2, "", "en"), (3, " .,\n", "en"), (4, "a b", "en")])).count() == 0
    rows = [(None, "a b", None)] * 10
    got = collocations.collocations(docs(spark, rows)).collect()
    assert [tuple(r) for r in got] == [("und", 1, "a b", 10, 10, 10, 20, 1_000_000)]


# ------------------------------------------------------------------ spelling variants

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, shortest=6, least=5, modulus=199, times=5):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    out, form = [], {}
    for w, n in words.items():
        found = sorted((-words[o], o) for o in words if near(w, o))
        if found and -found[0][0] >= times * n:
            form[w] = found[0][1]
        out.append((w, n, len(found)))
    full = []
    for w, n, k in out:
        root = w
        while root in form:
            root = form[root]
        full.append((w, n, k, form.get(w), words.get(form.get(w)), root))
    return sorted(full, key=repr)


def misspelt(rng, count=160, alphabet="abcdeéÉ\u00d7ü"):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(4, 9))) for _ in range(12)] + ["aaaaaaa", "bbbbbbbb", "abcdefg", "gfedcba"]
    rows = []
    for i in range(count):
        out = []
        for _ in range(40):
            w = rng.choice(base)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcé") + w[k:], w[:k] + rng.choice("abcé") + w[k + 1 :]])
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i * 37 % 1001, rng.choice([" ", "-", "漢", "1"]).join(out)))
    return rows


COLUMNS13 = ("word", "n", "n_near", "form", "form_n", "root")


@pytest.mark.parametrize("cells", [{}, {"cell_words": 8, "sample_words": 200}])
def test_spelling_variants(spark, cells):
    rng = random.Random(11)
    long = "y" * 400
    rows = misspelt(rng) + awkward() + [(None, "yearly yearlx " * 9), (-5, f"{long} {long}z {long[1:]} " * 6)] + [(9, "repeated words")] * 7
    got = spelling.variants(docs(spark, rows).repartition(4), modulus=7, times=2, **cells)
    assert got.columns == list(COLUMNS13)
    want = plain_variants(rows, modulus=7, times=2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert max(w[2] for w in want) > 3 and any(w[3] and w[5] != w[3] for w in want)


def test_spelling_of_long_texts_in_parts(spark, monkeypatch):
    rows = misspelt(random.Random(12), 20)
    monkeypatch.setattr(spelling, "PART", 30)
    monkeypatch.setattr(spelling, "REMEMBERED", 20)
    monkeypatch.setattr(spelling, "LEAF", 2)
    monkeypatch.setattr(spelling, "MOST_PAIRS", 5)
    got = spelling.variants(docs(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_variants(rows)


def test_tree_search_prunes_boxes_and_loses_nothing():
    rng = np.random.default_rng(6)
    points = rng.integers(0, 4, (400, spelling.LETTERS)).astype(np.uint8)
    points[:, 8:] = 0
    tree = spelling.Tree(points, 5)
    assert sorted(np.concatenate(tree.leaves).tolist()) == list(range(400))
    at = spelling.leaf_of(tree.nodes, points)
    assert all(at[i] == leaf for leaf, rows in enumerate(tree.leaves) for i in rows)
    for up, down in ((1, 1), (1, 0)):
        pairs = 0
        seen = {leaf: set(rows.tolist()) for leaf, rows in spelling.reached(tree.nodes, points, up, down)}
        for q in range(400):
            change = points.astype(int) - points[q]
            for p in np.flatnonzero((np.maximum(change, 0).sum(1) <= up) & (np.maximum(-change, 0).sum(1) <= down)):
                assert q in seen[at[p]]
            pairs += sum(q in s for s in seen.values())
        assert pairs < 400 * len(tree.leaves) / 2  # boxes are pruned


def test_roots_follow_long_chains(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "y")]
    got = spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()
    assert {r["word"]: r["root"] for r in got} == {**{f"w{i}": "w37" for i in range(37)}, "x": "y"}


def test_spelling_defined_cases(spark):
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, None), (2, ""), (3, "12 !"), (4, "seldom")])).count() == 0


# ------------------------------------------------------------------ byte-wise dedup

def plain_bytes(rows, width):
    raw = [(i, (t or "").encode()) for i, t in rows]
    starts = Counter(b[k : k + width] for _, b in raw for k in range(len(b) - width + 1))
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - width + 1):
            if starts[b[k : k + width]] > 1:
                gone[k : k + width] = True
        spans = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)]))).reshape(-1, 2).tolist()
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((i, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans))
    return sorted(out, key=repr)


COLUMNS12 = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")


def passages(rng, count=60):
    """Texts that share passages, end in them, repeat themselves, or differ by single letters."""
    shared = [words(rng, n, 500) for n in (12, 30, 80)] + ["ß漢" * 40, "ab" * 90, "x" * 150]
    rows = []
    for i in range(count):
        parts = [words(rng, rng.randrange(25), 900), rng.choice(shared), words(rng, rng.randrange(25), 900), rng.choice(shared)]
        text = rng.choice(["", " "]).join(parts[: rng.randrange(1, 5)])
        if rng.random() < 0.5 and text:
            k = rng.randrange(len(text))
            text = text[:k] + rng.choice(["", "é", "zz"]) + text[k + 1 :]
        rows.append((i * 31 % 997, text))
    return rows


@pytest.mark.parametrize("sizes", [{}, {"batch_chars": 700, "bucket_entries": 20}])
@pytest.mark.parametrize("width, core", [(64, 40), (50, 1), (30, 30), (7, 256)])
def test_byte_dedup(spark, monkeypatch, width, core, sizes):
    if sizes:
        monkeypatch.setattr(byte_dedup, "SLICE", 300)
    rng = random.Random(width)
    rows = passages(rng) + awkward() + [(None, "once more " * 9), (None, "once more " * 9), (5, None), (5, "")]
    got = byte_dedup.byte_dedup(docs(spark, rows).repartition(3), width=width, core=core, **sizes)
    assert got.columns == list(COLUMNS12)
    want = plain_bytes(rows, width)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert sum(w[2] for w in want) > 2000


def test_byte_dedup_of_a_passage_that_most_texts_share(spark):
    rng = random.Random(1)
    passage = words(rng, 60, 5000)
    rows = [(i, words(rng, 20, 5000) + " " + passage + " " + words(rng, 20, 5000)) for i in range(150)] + [(1000 + i, passage) for i in range(40)]
    got = byte_dedup.byte_dedup(docs(spark, rows), width=100, core=64, batch_chars=9_000, bucket_entries=300)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_bytes(rows, 100)


def test_byte_dedup_defined_cases(spark):
    assert byte_dedup.byte_dedup(docs(spark, [])).count() == 0
    text = "".join(chr(0x100 + i % 500) for i in range(200))  # 400 bytes
    got = byte_dedup.byte_dedup(docs(spark, [(1, text), (1, text), (2, text[:-1]), (3, None)])).collect()
    assert sorted(tuple(r)[:4] for r in got) == [(1, 400, 400, 1), (1, 400, 400, 1), (2, 398, 0, 0), (3, 0, 0, 0)]


def test_slices_and_runs_of_windows():
    keys = np.random.default_rng(3).integers(0, 1 << 62, 500, dtype=np.uint64)
    for width in (1, 7, 64, 500):
        want = [keys[i : i + width].min() for i in range(500 - width + 1)]
        assert byte_dedup.sliding_least(keys, width).tolist() == want
    texts = ["one text of some length, " * 9, None, "", "another one " * 20]
    batch = byte_dedup.Batch(texts, 50, 20)
    covered = [s.base + i for s in batch.slices() for i in byte_dedup.windows_of(s.first, s.last).tolist()]
    first, last = len(texts[0]), len(texts[0]) + len(texts[3])
    assert covered == [*range(first - 49), *range(first, last - 49)]
