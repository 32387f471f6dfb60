"""Exact dedup, Jaccard join, substring dedup, BPE and mixing against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import awkward, docs, words
from waymend.llm import bpe, exact_dedup, jaccard_join, mixing, substring_dedup
from waymend.llm.components import components

GAP = re.compile(r"[\x20\x09-\x0D]+")
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"


def split(text):
    return [w for w in GAP.split(text or "") if w]


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# ------------------------------------------------------------------ exact dedup

def plain_exact(rows):
    bodies = {}
    for i, t in rows:
        bodies.setdefault(GAP.sub("", t or ""), []).append((-len(t or ""), i))
    return sorted(
        (i, min(bodies[b])[1], len(bodies[b]), (-len(t or ""), i) == min(bodies[b]), hashlib.sha256(b.encode()).hexdigest())
        for i, t in rows for b in [GAP.sub("", t or "")]
    )


COLUMNS7 = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_dedup(spark):
    rows = awkward() + [(1000 + i, "same  text" if i % 3 else "same text") for i in range(60)]
    assert found(exact_dedup.exact_dedup(docs(spark, rows)), *COLUMNS7) == plain_exact(rows)


def test_exact_dedup_compares_contents_when_digests_collide(spark):
    rows = awkward(2)
    got = exact_dedup.exact_dedup(docs(spark, rows), salts=3, digest=lambda c: F.length(c).cast("string"))
    assert found(got, *COLUMNS7) == plain_exact(rows)


def test_exact_dedup_repeated_rows_and_empty_table(spark):
    got = exact_dedup.exact_dedup(docs(spark, [(5, "a b"), (5, "a b"), (4, "ab")]))
    assert found(got, "doc_id", "keep_id", "group_size", "kept") == [(4, 5, 3, False), (5, 5, 3, True), (5, 5, 3, True)]
    assert exact_dedup.exact_dedup(docs(spark, [])).count() == 0


# ------------------------------------------------------------------ Jaccard join

def plain_sets(rows, width=4):
    out = {}
    for i, t in rows:
        w = split("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def plain_components(rows, num=85, den=100, width=4):
    sets = plain_sets(rows, width)
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((i, len(sets[i]), root(i)) for i in ids)


COLUMNS6 = ("doc_id", "n_shingles", "component_id")


@pytest.mark.parametrize("similarity", [(85, 100), (1, 2), (1, 1)])
def test_jaccard_join(spark, similarity):
    rows = awkward()
    got = jaccard_join.jaccard_join(docs(spark, rows), similarity=similarity)
    assert found(got, *COLUMNS6) == plain_components(rows, *similarity)


def test_jaccard_join_of_a_family_in_small_tiles(spark):
    rng = random.Random(5)
    base, rows = words(rng, 60, 500).split(), []
    for i in range(150):  # near copies around the threshold, and texts that share a passage only
        text = base.copy()
        for _ in range(rng.randrange(1, 4)):
            text[rng.randrange(60)] = f"z{rng.randrange(10)}"
        rows.append((i * 7 % 150 + 1000 * (i % 2), " ".join(text)))
    rows += [(5000 + i, " ".join(base[:20]) + " " + words(rng, 30, 4000)) for i in range(60)]
    got = jaccard_join.jaccard_join(docs(spark, rows).repartition(5), tile_rows=7, most_hot=50)
    assert found(got, *COLUMNS6) == plain_components(rows)


def test_jaccard_join_defined_cases(spark):
    assert jaccard_join.jaccard_join(docs(spark, [])).count() == 0
    got = jaccard_join.jaccard_join(docs(spark, [(2, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f")]))
    assert sorted(map(tuple, got.select(*COLUMNS6).collect()), key=repr) == sorted([(2, 3, 1), (2, 3, 1), (1, 3, 1), (None, 3, None)], key=repr)


def test_jaccard_join_of_ids_with_several_texts(spark):
    a, b = "a b c d e f", "g h i j k l"
    got = jaccard_join.jaccard_join(docs(spark, [(3, a), (5, a), (5, b), (5, ""), (8, b), (4, ""), (None, b), (9, "m n o p")]))
    want = [(3, 3, 3), (5, 3, 3), (5, 3, 3), (5, 0, 3), (8, 3, 3), (4, 0, 4), (None, 3, None), (9, 1, 9)]
    assert sorted(map(tuple, got.select(*COLUMNS6).collect()), key=repr) == sorted(want, key=repr)


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(3)
    for n in (1, 5, 40, 700, 3000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        for change in (0, 1, max(1, n // 12), n):
            b = np.unique(np.concatenate([a[change:], rng.integers(0, 1 << 63, change, dtype=np.uint64)]))
            for share in (jaccard_join.NARROW, jaccard_join.WIDE):
                far = jaccard_join.apart([jaccard_join.bitmap(a, share)], [jaccard_join.bitmap(b, share)])[0]
                assert far <= len(np.setxor1d(a, b))


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, 5000 + i) for i in range(1, 80)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = found(components(spark.createDataFrame(links, "a long, b long")), "node", "component")
    assert got == sorted((i, root(i)) for i in up)


# ------------------------------------------------------------------ substring dedup

def plain_substrings(rows, window=13):
    first = {}
    lists = [(i, split(t)) for i, t in rows]
    for i, w in lists:
        for k in range(len(w) - window + 1):
            s = tuple(w[k : k + window])
            first[s] = min(first.get(s, i), i)
    out = []
    for i, w in lists:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


COLUMNS8 = ("doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize("chars", [8_000_000, 3_000])
def test_substring_dedup(spark, chars):
    rng = random.Random(4)
    rows, passage = awkward(), words(rng, 50, 900)
    for i in range(40):  # one passage in many texts, partly overlapping, and low-entropy texts
        cut = passage.split()[rng.randrange(20) : rng.randrange(30, 51)]
        rows.append((2000 - 7 * i, words(rng, rng.randrange(30), 900) + " " + " ".join(cut) + " " + words(rng, rng.randrange(30), 900)))
        rows.append((3000 + i, words(rng, rng.randrange(60), 2)))
    got = substring_dedup.substring_dedup(docs(spark, rows), batch_chars=chars)
    assert found(got, *COLUMNS8) == plain_substrings(rows)
    for r in got.where("n_removed > 0").collect():
        assert sum(b - a for a, b in r["removed"]) == r["n_removed"]


def test_substring_dedup_defined_cases(spark):
    text = " ".join(f"v{i}" for i in range(20))
    got = substring_dedup.substring_dedup(docs(spark, [(1, text), (1, text), (None, text), (0, None)]))
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in got.collect()) == [(-1, 0, 0), (-1, 20, 0), (1, 20, 0), (1, 20, 0)]
    assert substring_dedup.substring_dedup(docs(spark, [])).count() == 0


# ------------------------------------------------------------------ BPE

def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    rng = random.Random(8)
    bits = ["a", "e", "th", "ing", " ", "  ", "\n", "1", "23", "é", "ß", "漢字", "😀", "'s", "'LL", "!!", "\t", "aaaa", "Ġ", "<|endoftext|>", "　", "\x1c", "x" * 70]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(50))) for _ in range(400)]
    texts += [None, "", " ", "ab" * 4000, " " * 3000 + "x", "".join(rng.choice("abc ") for _ in range(3000))] + [t for _, t in awkward()]
    df = docs(spark, [(i, t) for i, t in enumerate(texts)]).withColumn("n_tokens", F.lit("clash"))
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    coded = bpe.encode(df, TOKENIZER)
    got = {r["doc_id"]: (r["token_ids"], r["n_tokens_"]) for r in coded.select("doc_id", "token_ids", "n_tokens_").collect()}
    assert got == {i: (w.ids, len(w.ids)) for i, w in enumerate(want)}
    back = {r["doc_id"]: r["decoded"] for r in bpe.decode(coded, TOKENIZER).select("doc_id", "decoded").collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    both = {r["doc_id"]: r for r in bpe.encode_and_decode(df, TOKENIZER).collect()}
    for i, w in enumerate(want):
        assert both[i]["ids_sha256"] == hashlib.sha256(np.array(w.ids, "<u4").tobytes()).hexdigest()
        assert both[i]["decoded_sha256"] == hashlib.sha256((texts[i] or "").encode()).hexdigest()
    assert bpe.encode(docs(spark, []), TOKENIZER).count() == 0


def test_bpe_of_slices_without_a_new_word(spark):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(TOKENIZER)
    copies = [(i, "the same words again") for i in range(1200)]
    for rows in ([(1, ""), (2, "")], [(1, None)], [(1, "<|endoftext|>"), (2, "<|endoftext|><|endoftext|>")], copies):
        for r in bpe.encode_and_decode(docs(spark, rows).coalesce(1), TOKENIZER, with_ids=True).collect():
            text = dict(rows)[r["doc_id"]] or ""
            ids = library.encode(text, add_special_tokens=False).ids
            assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
            assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_long_texts_in_pieces(monkeypatch):
    with open(TOKENIZER) as file:
        content = file.read()
    whole = bpe.Coder(content)
    text = " ".join(t or "" for _, t in awkward()) * 3
    want = whole.encode([text, "b"])
    monkeypatch.setattr(bpe, "PIECE", 400)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    assert bpe.Coder(content).encode([text, "b"]) == want and whole.decode(want[0]) == text


def test_compatible_pairs_are_those_that_merging_leaves():
    with open(TOKENIZER) as file:
        v = bpe.Vocabulary(file.read())
    rng = np.random.default_rng(1)
    # Pairs of short tokens: many of them would merge otherwise.
    short = np.flatnonzero((v.sizes <= 4) & (np.arange(v.size) != 50256))
    a, b = rng.choice(short, 3000), rng.choice(short, 3000)
    want = [v.merge_long(v.token_bytes[x] + v.token_bytes[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    assert v.compatible(a, b).tolist() == want


# ------------------------------------------------------------------ mixing

def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    got = mixing.targets([10, 100, 100], [5, 2, 1])
    assert got[0] == 30 and abs(sum(got) - 210) < 1e-9 and abs(got[1] - 2 * got[2]) < 1e-9
    assert mixing.targets([0, 0], [5, 2]) == [0, 0] and mixing.targets([], []) == []


def test_fill_is_exact_where_a_sum_exists():
    rng = random.Random(2)
    for _ in range(200):
        lengths = np.array(sorted(rng.sample(range(1, 60), rng.randrange(1, 7))))
        counts = np.array([rng.randrange(0, 5) for _ in lengths])
        budget = rng.randrange(0, 150)
        sums = {0}
        for l, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + k * l for s in sums for k in range(c + 1)}
        taken = mixing.fill(budget, lengths, counts)
        assert (taken >= 0).all() and (taken <= counts).all()
        assert int((taken * lengths).sum()) == max(s for s in sums if s <= budget)


def test_choice_meets_the_budget_where_a_sum_exists():
    rng = random.Random(3)
    for case in range(300):
        lengths = np.array(sorted(rng.sample(range(1, 300), rng.randrange(1, 9))))
        counts = np.array([rng.randrange(0, 4) for _ in lengths])
        total = int((lengths * counts).sum())
        budget = rng.randrange(total + 1) if case % 2 else max(0, total - rng.randrange(60))  # near-full ones as well
        sums = {0}
        for l, c in zip(lengths.tolist(), counts.tolist(), strict=True):
            sums = {s + k * l for s in sums for k in range(c + 1)}
        taken = mixing.choose(budget, lengths, counts, case)
        got = int((taken * lengths).sum())
        assert (taken >= 0).all() and (taken <= counts).all()
        # The nearest sum on the side that is chosen: taken ones from below, left-out ones from below.
        best = max(s for s in sums if s <= budget) if 2 * budget <= total else min(s for s in sums if s >= budget)
        assert got == best
        # Beyond the table's size whole documents go first; what they leave is still filled.
        rough = mixing.choose(budget, lengths, counts, case, most_cells=50)
        assert (rough >= 0).all() and (rough <= counts).all()


def test_mix(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, rng.randrange(1, 40)), "en", rng.choice(["a", "b", "b", "b", "c", "é", None])) for i in range(900)]
    rows += [(5000 + i, "one two three", "en", "b") for i in range(300)] + [(9000, None, "en", "a"), (9001, "", "en", "zero"), (9002, "x", "en", "tiny")]
    df = docs(spark, rows)
    got = {r["doc_id"]: r for r in mixing.mix(df, range_rows=50).collect()}
    assert len(got) == len(rows)
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(split(t))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, mixing.targets([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))]), strict=True))
    taken = {}
    for i, t, _, s in rows:
        r = got[i]
        assert r["size"] == len(split(t)) and r["source_size"] == sizes[s] and r["target"] == want[s]
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in names:
        assert abs(taken[s] - want[s]) <= 1, (s, taken[s], want[s])
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(df.repartition(7), range_rows=50).collect()}
    assert again == {i: r["taken"] for i, r in got.items()}


def test_mix_defined_cases(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    got = mixing.mix(docs(spark, [(1, None, "en", None), (2, " ", "en", "a")]))
    assert found(got, "doc_id", "size", "target", "taken") == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    twice = mixing.mix(docs(spark, [(1, "a b", "en", "a"), (1, "a b", "en", "a")]))
    assert found(twice, "doc_id", "taken") == [(1, 2), (1, 2)]
