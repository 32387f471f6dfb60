"""Language of texts by error-correcting output codes.

Every language gets a codeword of +1 and -1; for each bit of the codewords a binary
classifier (log-odds of hashed letter n-grams inside words) predicts the bit of a text.
The decoder weighs each bit by how reliable it was for the language in question, takes the
codeword with the least weighted logistic loss, and flags texts whose second-best codeword
is close.

n-gram counts come from all learned rows: tasks count by language, Spark adds the counts
up, and what reaches the driver is one weight per bit and place (2**bits places). The
reliabilities are measured on a bounded, hashed sample of learned rows. Texts are then
scored in one pass without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows without a
language are not learned; when nothing is learned every text is ``und``; with a single
language every text with letters gets it; ties go to the language that sorts first; repeated
rows count and are scored each; extra columns are ignored or kept; texts of any length are read
in pieces cut between words, so that their length changes no n-gram.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymend.llm.common import FACTORS, free_name, mixed

LETTERS = regex.compile(r"\p{L}+")
SIZES = (1, 2, 3)
REMEMBERED, LONG_WORD, PIECE = 150_000, 40, 1_000_000
#: No single n-gram says more than this; how steeply a margin becomes a loss.
MOST_ODDS, STEEP = 3.0, 3.0


def codewords(languages: int, seed: int = 5) -> np.ndarray:
    """languages x bits of +1 and -1: all splits for up to 6 languages, else random distinct ones."""
    if languages <= 1:
        return np.ones((languages, 1), np.int8)
    if languages <= 6:
        splits = np.arange(1 << (languages - 1), (1 << languages) - 1)
        return np.where((splits[None, :] >> np.arange(languages - 1, -1, -1)[:, None]) & 1, 1, -1).astype(np.int8)
    random, bits = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(languages)))
    best, distance = None, -1
    for _ in range(20):
        code = random.choice(np.array([-1, 1], np.int8), (languages, bits))
        code = code[:, np.abs(code.sum(0, dtype=int)) < languages]  # every bit must split them
        dots = code.astype(int) @ code.T.astype(int) - np.diag(np.full(languages, 10**6))
        least = code.shape[1] - dots.max()
        if least > distance:
            best, distance = code, least
    return best


def word_grams(words: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams of all words (with a border at both ends), and whose they are."""
    points = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    places, owners = [], []
    for n in SIZES:
        count = len(points) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h = h * FACTORS[0] + points[i : i + count]
        inside = owner[:count] == owner[n - 1 :]
        places.append((mixed(h)[inside] >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[:count][inside])
    return np.concatenate(places), np.concatenate(owners)


def word_pieces(text: str) -> Iterator[list[str]]:
    """Lower-cased words; a long text piece by piece, cut between words."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and text[end].isalpha() and text[end - 1].isalpha():
            end += 1  # never inside a word
        yield LETTERS.findall(text[start:end].lower())
        start = end


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # places x bits
    trust: np.ndarray  # languages x bits

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """texts x languages, weighted by trust."""
        loss = np.log1p(np.exp(-np.clip(STEEP * margins[:, None, :] * self.code[None], -50, 50)))
        return (loss * self.trust[None]).sum(2) / self.trust.sum(1)[None]


class Margins:
    """Mean log-odds of a text's n-grams, for each bit."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.bits = weights, len(weights).bit_length() - 1
        self.known: dict[str, int] = {}
        self._reset()

    def _reset(self):
        self.known.clear()
        self.table = np.zeros((1024, self.weights.shape[1] + 1))  # sums over a word, and how many

    def _vectors(self, words: list[str]) -> np.ndarray:
        places, owner = word_grams(words, self.bits)
        order = np.argsort(owner, kind="stable")
        starts = np.searchsorted(owner[order], np.arange(len(words)))
        sums = np.add.reduceat(self.weights[places[order]].astype(np.float64), starts, axis=0)
        return np.column_stack([sums, np.bincount(owner, minlength=len(words))])

    def _learn(self, words: set[str]) -> None:
        fresh = sorted(words.difference(self.known))
        if not fresh:
            return
        need = len(self.known) + len(fresh)
        if need > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((need, self.table.shape[1]))])
        for at in range(0, len(fresh), 20_000):
            some = fresh[at : at + 20_000]
            first = len(self.known)
            self.table[first : first + len(some)] = self._vectors(some)
            self.known.update(zip(some, range(first, first + len(some)), strict=True))

    def of(self, text: str) -> np.ndarray | None:
        total = np.zeros(self.weights.shape[1] + 1)
        for words in word_pieces(text):
            if len(self.known) > REMEMBERED:
                self._reset()
            long = [w for w in words if len(w) > LONG_WORD]
            if long:
                words = [w for w in words if len(w) <= LONG_WORD]
                for w in long:
                    total += self._vectors([w])[0]
            self._learn(set(words))
            total += self.table[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))].sum(0)
        return total[:-1] / total[-1] if total[-1] else None


def gram_counts(learned: DataFrame, text_col: str, lang_col: str, bits: int) -> DataFrame:
    """lang, place, n over all rows of ``learned``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def settle():
            for lang, seen in words.items():
                total = counts.setdefault(lang, np.zeros(1 << bits))
                some = list(seen)
                for at in range(0, len(some), 20_000):
                    part = some[at : at + 20_000]
                    places, owner = word_grams(part, bits)
                    times = np.array([seen[w] for w in part], np.float64)
                    total += np.bincount(places, weights=times[owner], minlength=1 << bits)
            words.clear()

        def emptied():
            for lang, total in counts.items():
                places = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(total[places].astype(np.int64))],
                    names=["lang", "place", "n"],
                )
            counts.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for piece in word_pieces(text or ""):
                    words.setdefault(lang, Counter()).update(piece)
                if sum(map(len, words.values())) > 2 * REMEMBERED:
                    settle()
                if len(counts) + len(words) > 100:  # hand on what many languages have gathered
                    settle()
                    yield from emptied()
        settle()
        yield from emptied()

    counted = learned.select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")).mapInArrow(run, "lang string, place long, n long")
    return counted.groupBy("lang", "place").agg(F.sum("n").alias("n"))


def margins(docs: DataFrame, weights: np.ndarray, keep: list[str], text_col: str, added: str) -> DataFrame:
    """``keep`` columns and an array of margins (null for texts without letters)."""
    base = docs.select(*keep)
    base_names = base.columns
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema = T.StructType([*base.schema.fields, T.StructField(added, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Margins(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = [scorer.of(t or "") for t in part.column(part.num_columns - 1).to_pylist()]
                column = pa.array([None if m is None else m.tolist() for m in found], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], names=[*base_names, added])

    hidden = free_name(base, "_text")
    return docs.select(*keep, F.col(text_col).cast("string").alias(hidden)).mapInArrow(run, schema)


def train(learned: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", bits=15, trust_rows=4_000, seed=3, most_languages=2_000) -> Model:
    """Model from all rows of ``learned`` that have a language."""
    rows = learned.where(F.col(lang_col).isNotNull())
    from waymend.llm.common import staged

    counts = staged(gram_counts(rows, text_col, lang_col, bits))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").limit(most_languages + 1).collect()
    if len(totals) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    languages = [r["lang"] for r in totals]
    code, size = codewords(len(languages)), 1 << bits
    if len(languages) < 2:
        return Model(languages, code, np.zeros((size, code.shape[1])), np.ones(code.shape))
    signs = counts.sparkSession.createDataFrame(
        [(lang, [int(c) for c in code[i]]) for i, lang in enumerate(languages)], "lang string, code array<int>"
    )
    # Shares by language first, so that each language weighs the same on its side of a bit.
    shares = counts.join(F.broadcast(signs), "lang").join(
        F.broadcast(counts.groupBy("lang").agg(F.sum("n").alias("total"))), "lang"
    ).withColumn("share", F.col("n") / F.col("total"))
    sides = shares.select("place", "share", F.posexplode("code").alias("bit", "sign")).groupBy("bit", "place").agg(
        F.sum(F.when(F.col("sign") > 0, F.col("share")).otherwise(0.0)).alias("yes"),
        F.sum(F.when(F.col("sign") < 0, F.col("share")).otherwise(0.0)).alias("no"),
    )
    yes, no = np.zeros((size, code.shape[1])), np.zeros((size, code.shape[1]))
    found = sides.toPandas()  # at most 2**bits places for each bit
    yes[found["place"], found["bit"]], no[found["place"], found["bit"]] = found["yes"], found["no"]
    small = 1e-6
    weights = np.log((yes / (code > 0).sum(0) + small) / (no / (code < 0).sum(0) + small)).clip(-MOST_ODDS, MOST_ODDS)
    sample = rows.select(F.col(id_col).alias("_id")).orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(trust_rows)
    picked = rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).cast("string").alias("lang")).join(
        F.broadcast(sample.distinct()), "_id"
    )
    judged = margins(picked, weights, ["lang"], "_text", "margins").where("margins is not null")
    right = judged.join(F.broadcast(signs), "lang").select("lang", F.posexplode(F.arrays_zip("margins", "code")).alias("bit", "x"))
    shares = right.groupBy("lang", "bit").agg(F.avg((F.signum("x.margins") == F.col("x.code")).cast("double")).alias("right")).collect()
    trust = np.full(code.shape, 0.5)
    for r in shares:
        trust[languages.index(r["lang"]), r["bit"]] = max(0.05, r["right"])
    return Model(languages, code, weights, trust)


def identify(docs: DataFrame, model: Model, text_col="text", keep: list[str] | None = None, ambiguous_below=0.6) -> DataFrame:
    """``keep`` columns (default: all), lang_pred, score (0 to 1) and ambiguous."""
    kept = docs.columns if keep is None else keep
    base = docs.select(*kept)
    base_names = base.columns
    names = [free_name(base, n) for n in ("lang_pred", "score", "ambiguous")]
    schema = T.StructType([
        *base.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()),
        T.StructField(names[2], T.BooleanType()),
    ])
    # Plain lists and arrays: a broadcast names its classes by their module, which executors need not have.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.code, model.weights.astype(np.float32), model.trust))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        scorer = Margins(m.weights)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = [scorer.of(t or "") for t in part.column(part.num_columns - 1).to_pylist()]
                known = np.array([f is not None for f in found]) & bool(m.languages)
                best, score, close = [None] * len(found), np.zeros(len(found)), np.zeros(len(found), bool)
                if known.any():
                    loss = m.losses(np.array([f for f, k in zip(found, known, strict=True) if k]))
                    chance = np.exp(-2 * (loss - loss.min(1, keepdims=True)))
                    chance /= chance.sum(1, keepdims=True)
                    order = np.argsort(loss, axis=1, kind="stable")
                    score[known] = np.take_along_axis(chance, order[:, :1], 1)[:, 0]
                    if len(m.languages) > 1:
                        gap = np.take_along_axis(loss, order[:, 1:2], 1) - np.take_along_axis(loss, order[:, :1], 1)
                        close[known] = gap[:, 0] < ambiguous_below
                    for i, k in zip(np.flatnonzero(known), order[:, 0], strict=True):
                        best[i] = m.languages[k]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([b or "und" for b in best], pa.string()), pa.array(score), pa.array(close)],
                    names=[*base_names, *names],
                )

    hidden = free_name(base, "_text")
    return docs.select(*kept, F.col(text_col).cast("string").alias(hidden)).mapInArrow(run, schema)
