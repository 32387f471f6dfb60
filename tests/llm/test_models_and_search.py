"""Search, URL filter, revisits, quality and language: plain versions or held-out accuracy."""

import random
import time
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.data import docs, words
from waymend.llm import language, quality, topk_search, url_filter, warc
from waymend.llm.queries import URL_RULES

# ------------------------------------------------------------------ top-k

VECTORS = "vec_id long, vector array<double>, score string, width string, rank string"


def plain_top_k(rows, asks, k):
    out = []
    for q, x in rows:
        if asks(q):
            scored = sorted((-sum(int(a) * int(b) for a, b in zip(x, y, strict=True)), i) for i, y in rows if i != q and len(y) == len(x))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def searched(spark, rows, k, **more):
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], VECTORS)
    got = topk_search.top_k(df, F.col("vec_id") % 10 == 0, k=k, **more)
    return sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("shard_rows", [10_000, 60])
def test_top_k(spark, shard_rows):
    rng = random.Random(1)
    rows = [(i, [float(rng.randrange(-5, 6)) for _ in range(4)]) for i in range(400)]
    rows += [(1000 + i, [3.0, 3.0, 3.0, 3.0]) for i in range(150)]  # ties and a hot vector
    rows += [(2000 + i, [1.0, float(i)]) for i in range(11)] + [(3000, []), (3001, []), (3010, [7.0] * 9)]
    assert searched(spark, rows, 7, shard_rows=shard_rows) == plain_top_k(rows, lambda q: q % 10 == 0, 7)


def test_top_k_of_large_components(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-10**9, 10**9)) for _ in range(3)]) for i in range(60)]
    assert searched(spark, rows, 5) == plain_top_k(rows, lambda q: q % 10 == 0, 5)


def test_top_k_leaves_out_unusable_vectors(spark):
    bad = [(10, None), (11, [1.0, None]), (12, [float("nan"), 1.0]), (13, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    rows = [(20, [1.0, 2.0]), (21, [3.0, 4.0]), (20, [1.0, 2.0])]
    assert searched(spark, rows + bad, 3) == [(20, 1, 21, 11)]
    assert searched(spark, bad, 3) == [] and searched(spark, [], 3) == []


# ------------------------------------------------------------------ URL filter

def plain_listed(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in URL_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return host, path, *(best or (None, None))


URLS = [
    None, "", "no scheme.net/x", "http://A.Example.NET/en/1?q=1#x", "https://example.net/en", "https://example.net/de/", "http://net", "http://xnet/",
    "http://b.example.com/de/5", "http://example.com/fr/5", "http://org/fr/x", "http://a.org/fr", "http://a.org?x=/fr/", "://x.net#/a", "http://q?://z.net/",
    "http://É.net/", "http://h.com/" + "a/" * 3000, "http://a.net:80/", "x://y://z.net/", "http://a.org/fr/\nline",
]


def test_listed_rules(spark):
    df = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id long, url string, host string, rule string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(df, URL_RULES).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain_listed(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        if verdict:
            assert got[i]["verdict"] == verdict
        else:
            assert got[i]["verdict"] in ("allow", "block")
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(empty, URL_RULES).count() == 0


def plain_mined(labelled, min_support, min_confidence):
    """All token sets by brute force, pruned as the operator does."""
    from itertools import combinations

    n = len(labelled)
    tokens = sorted({t for ts, _ in labelled for t in ts})
    rules = {}
    for size in range(1, 5):
        for part in combinations(tokens, size):
            have = [v for ts, v in labelled if set(part) <= ts]
            for verdict in ("allow", "block"):
                hits = sum(v == verdict for v in have)
                if hits and hits >= np.ceil(min_support * n) and hits / len(have) >= min_confidence:
                    rules[part, verdict] = (hits / len(have), hits / n)
    return {
        (part, v): c for (part, v), c in rules.items()
        if not any(rules.get((tuple(x for x in part if x != t), v), (0,))[0] >= c[0] for t in part if len(part) > 1)
    }


def test_mined_rules_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        host, seg = rng.choice(["pills", "shop", "news", "blog"]), rng.choice(["en", "de", "buy"])
        bad = host == "pills" and rng.random() < 0.95 or seg == "buy" and rng.random() < 0.8
        rows.append((i, f"http://{host}.site.io/{seg}/{i}", "block" if bad else "allow"))
    df = spark.createDataFrame([(i, u) for i, u, _ in rows], "page_id long, url string")
    host, path = url_filter.split_url(F.col("url"))
    tokens = df.select("page_id", url_filter.url_tokens(F.col("url"), host, path).alias("tokens"))
    labels = spark.createDataFrame([(i, v) for i, _, v in rows if i % 2], "page_id long, label string")
    mined = url_filter.mine_rules(tokens.join(labels, "page_id"), 0.02, 0.7)
    by_id = {r["page_id"]: set(r["tokens"]) for r in tokens.collect()}
    want = plain_mined([(by_id[i], v) for i, _, v in rows if i % 2], 0.02, 0.7)
    got = {(tuple(r["rule_tokens"]), r["verdict"]): (r["confidence"], r["support"]) for r in mined.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in got)
    judged = {r["page_id"]: r for r in url_filter.filter_urls(df, URL_RULES, labels, min_support=0.02, min_confidence=0.7).collect()}
    for i, _, _ in rows:
        fits = [(-c, -s, list(part), v) for (part, v), (c, s) in want.items() if set(part) <= by_id[i]]
        assert judged[i]["verdict"] == (min(fits)[3] if fits else "allow")


def test_a_rule_that_hangs_on_the_third_path_part(spark):
    urls = [f"http://h.io/en/shop/pills/{i}/pills" if i % 2 else f"http://h.io/en/shop/books/{i}" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, "block" if i % 2 else "allow") for i in range(30)], "page_id long, label string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(df, [], labels, min_support=0.1, min_confidence=0.9).collect()}
    assert all(got[i]["verdict"] == ("block" if i % 2 else "allow") for i in range(40))
    assert all(got[i]["mined_rule"] == ("p:pills" if i % 2 else "p:books") for i in range(40))


def test_tokens_of_the_same_rows_are_one_item(spark):
    rng = random.Random(2)

    def judged(parts):
        shared = "/".join(f"part{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(parts))
        urls = [f"http://h.io/{shared}/{rng.choice(['buy', 'read'])}/x" for _ in range(60)]
        urls += ["http://h.io/partac/other", "http://h.io/buy"]  # one of the shared parts is enough
        df = spark.createDataFrame([*enumerate(urls), (3, urls[3])], "page_id long, url string")
        labels = spark.createDataFrame([(i, "block" if "/buy/" in u else "allow") for i, u in enumerate(urls[:40])] + [(3, "allow"), (3, "block")], "page_id long, label string")
        begin = time.time()
        got = [(r["page_id"], r["verdict"]) for r in url_filter.filter_urls(df, [], labels, min_support=0.1, min_confidence=0.6).collect()]
        return urls, sorted(got), time.time() - begin

    judged(3)  # warm
    urls, got, few = judged(6)
    urls, got, many = judged(30)
    assert many < 2 * few + 5
    want = ["block" if "/buy" in u else "allow" for u in urls]
    assert got == sorted([*enumerate(want), (3, want[3])])


# ------------------------------------------------------------------ revisits

CAPTURES = "record_id long, url string, at long, kind string, etag string, last_modified string, headers map<string,string>, found string"


def plain_resolved(rows):
    out = []
    for rid, url, at, kind, etag, modified, _ in rows:
        if kind != "revisit" or url is None or at is None:
            continue
        earlier = [r for r in rows if r[3] == "response" and r[1] == url and r[2] is not None and r[2] < at]
        if not earlier:
            out.append((rid, None, "no_response"))
            continue
        best = max(earlier, key=lambda r: (r[2], r[0]))
        if etag is not None and best[4] is not None:
            same = etag.removeprefix("W/") == best[4].removeprefix("W/")
        elif modified is not None and best[5] is not None:
            same = modified == best[5]
        else:
            out.append((rid, None, "no_validator"))
            continue
        out.append((rid, best[0], "resolved") if same else (rid, None, "changed"))
    return sorted(out)


@pytest.mark.parametrize("piece_rows", [200_000, 20])
def test_revisits(spark, piece_rows):
    rng = random.Random(7)
    rows = [
        (
            i, rng.choice(["http://hot.io/"] * 4 + [f"http://u{k}.io/" for k in range(5)]), rng.randrange(150), rng.choice(["response", "revisit", "revisit"]),
            rng.choice(["a", "W/a", "b", None]), rng.choice(["m1", "m2", None]), rng.choice([None, {"ETag": "x"}]),
        )
        for i in range(500)
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], CAPTURES)
    got = sorted((r["record_id"], r["refers_to"], r["verdict"]) for r in warc.resolve_revisits(df, piece_rows).collect())
    assert got == plain_resolved(rows)


def test_revisit_headers_and_defined_cases(spark):
    rows = [
        (1, "https://www.A.io/x/index.html?q", 1, "response", "t", None, {"Content-Type": "text/html", "ETag": "t", "Date": "d0"}, ""),
        (2, "http://a.io/x#f", 5, "revisit", "W/t", None, {"date": "d1", "Content-Type": "no", "Expires": "e"}, ""),
        (3, None, 5, "revisit", "t", None, None, ""), (4, "http://a.io/x", None, "revisit", "t", None, None, ""),
        (5, "http://a.io/x", 1, "revisit", "t", None, None, ""), (6, "http://a.io/x", 9, None, "t", None, None, ""),
    ]
    got = {r["record_id"]: r for r in warc.resolve_revisits(spark.createDataFrame(rows, CAPTURES)).collect()}
    assert got[2]["verdict"] == "resolved" and got[2]["url"] == "a.io/x"
    assert got[2]["headers"] == {"Content-Type": "text/html", "ETag": "t", "date": "d1", "Expires": "e"}
    assert got[5]["verdict"] == "no_response"  # the response at the same time is not earlier
    assert {got[i]["verdict"] for i in (3, 4, 6)} == {"not_a_capture"} and 1 not in got
    assert warc.resolve_revisits(spark.createDataFrame([], CAPTURES)).count() == 0


# ------------------------------------------------------------------ quality

def graded(rng, i):
    bad = rng.random() < 0.3
    text = " ".join(f"{rng.choice('abcde')}{rng.randrange(30)}" + ("!!" if bad and rng.random() < 0.5 else "") for _ in range(rng.randrange(5, 60)))
    return i, text, int(not bad)


def test_quality_on_held_out_rows(spark):
    rng = random.Random(4)
    rows = [graded(rng, i) for i in range(900)] + [(5000, None, 1), (5001, "", 0), (5002, "x" * 3_000_000, 1)]
    df = docs(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 3] + [(1, None), (None, 1)], "doc_id long, quality int")
    weights = quality.train(df, labels, bits=14, shards=2)
    got = {r["doc_id"]: r["score_"] for r in quality.score(df, weights).select("doc_id", "score_").collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values()) and got[5000] == got[5001]
    held = [(got[i] >= 0.5) == bool(q) for i, t, q in rows if i % 3 == 0 and t]
    assert np.mean(held) > 0.95
    again = quality.train(df.repartition(5), labels.repartition(3), bits=14, shards=2)
    assert np.allclose(weights, again, atol=1e-6)


def test_quality_scores_are_sparse_dot_products(spark):
    rng = random.Random(5)
    rows = [graded(rng, i) for i in range(40)]
    weights = np.random.default_rng(1).normal(size=(1 << 10) + 1)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs(spark, [(i, t) for i, t, _ in rows]), weights, keep=["doc_id"]).collect()}
    features = quality.Features(10)
    for i, t, _ in rows:
        dense = np.zeros(1 << 10)
        places, values = features.of(t)
        dense[places] = values
        assert abs(np.linalg.norm(dense) - 1) < 1e-9
        w = weights.astype(np.float32).astype(float)
        assert abs(got[i] - 1 / (1 + np.exp(-(dense @ w[:-1] + 0.3 * w[-1])))) < 1e-9


def test_follow_leader_against_a_plain_loop():
    rng = np.random.default_rng(3)
    examples = [(np.sort(rng.choice(6, 3, replace=False)), rng.normal(size=3), int(rng.integers(2))) for _ in range(40)]
    alpha, beta, l1, l2 = 1.5, 1.0, 0.01, 0.01
    z, n = [0.0] * 7, [0.0] * 7

    def weight(i):
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - (l1 if z[i] > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(2):
        for places, values, label in examples:
            x = [*zip(places.tolist(), values.tolist(), strict=True), (6, 0.3)]
            p = 1 / (1 + np.exp(-sum(weight(i) * v for i, v in x)))
            for i, v, w in [(i, v, weight(i)) for i, v in x]:
                g = (p - label) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * w
                n[i] += g * g
    got = quality.follow_leader(examples, 6, alpha, beta, l1, l2, epochs=2)
    assert np.allclose(got, [weight(i) for i in range(7)])


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    df = docs(spark, [(1, "a b"), (2, None)])
    scores = quality.score(df, quality.train(df, none, bits=8), keep=["doc_id"]).collect()
    assert [r["score"] for r in scores] == [0.5, 0.5]
    assert quality.score(docs(spark, []), np.zeros(257)).count() == 0


def test_quality_of_long_texts_in_pieces(monkeypatch):
    text = words(random.Random(3), 400)
    places, values = quality.Features(12).of(text)
    monkeypatch.setattr(quality, "PIECE", 50)
    again, more = quality.Features(12).of(text)
    assert (places == again).all() and np.allclose(values, more)


# ------------------------------------------------------------------ language

SYLLABLES = {"en": "the ing ation wh ou er", "de": "sch ung keit ßen ü ver", "fr": "eau ê tion oi que é", "es": "ción ñ ado ll mente que", "xx": "zx qq vk jw"}


def spoken(rng, lang):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(4, 40)))


@pytest.mark.parametrize("languages", [["en", "de"], ["en", "de", "fr", "es", "xx"]])
def test_language_on_held_out_rows(spark, languages):
    rng = random.Random(6)
    rows = [(i, spoken(rng, lang), lang) for i in range(600) for lang in [rng.choice(languages)]]
    df = docs(spark, [*rows, (9000, None, "en"), (9001, " 12 !", "de"), (9002, spoken(rng, "en"), None), (9003, "schung" * 200_000, None)])
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language.train(df.where(~held), bits=12)
    got = {r["doc_id"]: r for r in language.identify(df.drop("score"), model).collect()}
    right = [got[i]["lang_pred"] == lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(right) > 0.97 and model.languages == sorted(languages)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert (got[9000]["lang_pred"], got[9000]["score"], got[9001]["lang_pred"]) == ("und", 0.0, "und")
    assert got[9002]["lang_pred"] == "en" and got[9003]["lang_pred"] == "de"


def test_language_flags_mixed_texts(spark):
    rng = random.Random(7)
    rows = [(i, spoken(rng, lang), lang) for i in range(400) for lang in [rng.choice(["en", "de", "fr"])]]
    model = language.train(docs(spark, rows), bits=12)
    mixed = docs(spark, [(1, spoken(rng, "en") * 5, None), (2, "the sch ing ung er ver wh keit", None)])
    got = {r["doc_id"]: r["ambiguous"] for r in language.identify(mixed, model, keep=["doc_id"]).collect()}
    assert got == {1: False, 2: True}


def test_language_with_nothing_or_one_to_learn(spark):
    df = docs(spark, [(1, "abc", None), (2, None, None)])
    nothing = language.train(df, bits=8)
    assert [r["lang_pred"] for r in language.identify(df, nothing, keep=["doc_id"]).collect()] == ["und", "und"]
    one = language.train(docs(spark, [(1, "abc", "en")]), bits=8)
    assert sorted((r["lang_pred"], r["score"]) for r in language.identify(df, one, keep=["doc_id"]).collect()) == [("en", 1.0), ("und", 0.0)]
    assert language.identify(docs(spark, []), one).count() == 0


def test_language_of_long_texts_in_pieces(monkeypatch):
    text = spoken(random.Random(3), "fr") + " " + "z" * 90 + " 12 " + spoken(random.Random(4), "de")
    whole = [w for part in language.word_pieces(text) for w in part]
    for size in (1, 7, 50):
        monkeypatch.setattr(language, "PIECE", size)
        assert [w for part in language.word_pieces(text) for w in part] == whole
    assert list(language.word_pieces("")) == []


def test_language_margins_and_decoding_against_loops():
    rng = random.Random(8)
    weights = np.random.default_rng(2).normal(size=(256, 3)).astype(np.float32)
    text = spoken(rng, "de") + " " + spoken(rng, "es")
    sums, count = np.zeros(3), 0
    for word in [w for part in language.word_pieces(text) for w in part]:
        for place in language.word_grams([word], 8)[0]:  # one word at a time
            sums, count = sums + weights[place], count + 1
    got = language.Margins(weights).of(text)
    assert np.allclose(got, sums / count)
    code = np.array([[1, 1, -1], [1, -1, 1], [-1, 1, 1]], np.int8)
    trust = np.array([[0.9, 0.6, 0.7], [0.8, 0.8, 0.5], [0.6, 1.0, 0.9]])
    losses = language.Model(["a", "b", "c"], code, weights, trust).losses(got[None])[0]
    for lang in range(3):
        want = sum(trust[lang, b] * np.log(1 + np.exp(-language.STEEP * got[b] * code[lang, b])) for b in range(3)) / trust[lang].sum()
        assert abs(losses[lang] - want) < 1e-9


def test_language_counts_against_loops(spark):
    rows = [(i, spoken(random.Random(i), lang), lang) for i, lang in enumerate(["en", "de", "en", "fr"])]
    want = {}
    for _, text, lang in rows:
        for word in [w for part in language.word_pieces(text) for w in part]:
            for place in language.word_grams([word], 10)[0].tolist():
                want[lang, place] = want.get((lang, place), 0) + 1
    got = language.gram_counts(docs(spark, rows), "text", "lang", 10).collect()
    assert {(r["lang"], r["place"]): r["n"] for r in got} == want


def test_codewords_differ():
    for n in (2, 3, 6, 7, 40, 300):
        code = language.codewords(n)
        dots = code.astype(int) @ code.T.astype(int)
        assert code.shape[0] == n and (dots[~np.eye(n, dtype=bool)] < code.shape[1]).all()
        assert (np.abs(code.sum(0, dtype=int)) < n).all()
