"""The pipeline's stages against plain versions, on the smallest tables."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as p
from tests.llm.data import awkward, docs
from tests.llm.test_text_operators import TOKENIZER, plain_components, plain_exact
from waymend.llm import mixing
from waymend.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_stages_in_order(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    now = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    (q, quality_stage), (e, exact), (j, near), (m, mix), (b, tokens) = p.STAGES
    kept = []
    for k, stage in enumerate((quality_stage, exact, near, mix)):
        before = texts_of(now)
        stage(spark, now, FOLDER).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        assert now.columns == p.COLUMNS
        kept.append((before, texts_of(now)))
    before, after = kept[0]
    good = {i for i, y in labels.items() if y == 1} & {i for i, _ in before}
    assert len(good & {i for i, _ in after}) >= 0.98 * len(good)
    before, after = kept[1]
    assert sorted(i for i, _ in after) == sorted(r[0] for r in plain_exact(before) if r[3])
    before, after = kept[2]
    assert sorted(i for i, _ in after) == sorted(i for i, _, c in plain_components(before) if i == c)
    before, after = kept[3]
    rows = mixing.mix(spark.read.parquet(f"{tmp_path}/2")).collect()
    assert Counter(i for i, _ in after) == Counter({r["doc_id"]: r["times"] for r in rows if r["times"]})
    library = tokenizers.Tokenizer.from_file(TOKENIZER)
    texts = dict(after)
    out = tokens(spark, now, FOLDER).collect()
    assert len(out) == len(after)
    for r in out:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    whole = p.run(spark, FOLDER).collect()
    assert Counter((r["doc_id"], r["ids_sha256"]) for r in whole) == Counter((r["doc_id"], r["ids_sha256"]) for r in out)


def test_stages_on_awkward_rows_and_no_rows(spark):
    rows = awkward() + [(7, "twice"), (7, "twice")]
    for df, n in ((docs(spark, rows), len(rows)), (docs(spark, []), 0)):
        for name, stage in p.STAGES[:-1]:
            kept = stage(spark, df, FOLDER)
            assert kept.columns == p.COLUMNS and kept.count() <= 3 * n, name
        assert p.STAGES[-1][1](spark, df, FOLDER).count() == n
    empty = docs(spark, [(i, t) for i, t in enumerate([None, "", "", "<|endoftext|>"])])
    assert sorted(r["n_tokens"] for r in p.tokenize(spark, empty, FOLDER).collect()) == [0, 0, 0, 1]
    once = [i for i, _ in texts_of(p.drop_exact_copies(spark, docs(spark, rows), FOLDER))]
    assert once.count(7) == 1


def test_near_copies_from_four_fifths_of_five_word_shingles(spark):
    text = [f"w{k}" for k in range(100)]
    rows = [(2, " ".join(text)), (1, " ".join(text + [f"x{k}" for k in range(22)])), (3, " ".join(text + [f"y{k}" for k in range(30)]))]
    got = texts_of(p.drop_near_copies(spark, docs(spark, rows), FOLDER))
    assert sorted(i for i, _ in got) == [i for i, _, c in plain_components(rows, 4, 5, 5) if i == c] == [1, 3]


def test_rows_without_an_id_stay(spark):
    text = [f"w{k}" for k in range(100)]
    near, far = " ".join(text + ["x", "y"]), " ".join(f"v{k}" for k in range(50))
    text = " ".join(text)

    def after(stage, rows):
        return sorted(texts_of(stage(spark, docs(spark, [(*r, "en", "a") for r in rows]), FOLDER)), key=repr)

    exact, near_copies = p.drop_exact_copies, p.drop_near_copies
    assert after(exact, [(None, "a b"), (None, "c")]) == [(None, "a b"), (None, "c")]
    assert after(exact, [(5, "a b"), (None, "a b")]) == [(5, "a b")]
    # The longest of its group, and rows of one id and one text once the white space is gone.
    assert after(exact, [(5, "a b"), (None, "a  b"), (None, "ab"), (6, "ab")]) == [(None, "a  b")]
    assert after(exact, [(5, "ab"), (5, "a b"), (5, "ab")]) == [(5, "a b")]
    assert after(near_copies, [(None, text), (None, far), (3, "z")]) == sorted([(None, text), (None, far), (3, "z")], key=repr)
    assert after(near_copies, [(9, text), (None, near), (None, far), (7, near)]) == sorted([(7, near), (None, far)], key=repr)
    assert len(after(near_copies, [(None, text), (None, near)])) == 1
    # All documents of the one source fit its target.
    rows = [(None, text), (None, far), (3, "z")]
    assert after(p.mix_sources, rows) == sorted(rows, key=repr)
    assert len(p.tokenize(spark, docs(spark, rows), FOLDER).collect()) == 3


def test_every_operator_is_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
