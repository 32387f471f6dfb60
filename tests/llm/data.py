"""Small tables for the tests of the training-data operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, size string, score string, rank int, id string, key string, place string"


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]); with extra columns whose names operators use inside."""
    full = [(*r, *[None] * (4 - len(r))) for r in rows]
    return spark.createDataFrame([(i, t, l, s, len(t or ""), "h", "s", "x", 7, "i", "k", "p") for i, t, l, s in full], DOCS)


def words(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward(seed=1):
    """(doc_id, text): nulls, empties, white space, short, long, copies, near copies, odd characters."""
    rng = random.Random(seed)
    base = [words(rng, n, 60) for n in (3, 4, 12, 13, 14, 30, 60, 80, 200)]
    texts = [None, "", "  \t\n ", "a", "a b c", "A B C", "été à la plage", "x y z"] + base
    texts += [base[6] + " tail", base[7].replace(" ", "\n"), base[7].upper(), "pre " + base[8] + " post", base[5] + " " + base[6]]
    texts += [base[8]] * 3 + [words(rng, 5000, 3000)]
    near = base[8].split()
    for k in range(12):  # a chain: each differs a little from the one before
        near = near.copy()
        near[rng.randrange(len(near))] = f"n{k}"
        texts.append(" ".join(near))
    return [(10 * i + 3, t) for i, t in enumerate(texts)]
