"""Quality classifier: logistic regression on hashed word n-grams.

Words are runs of word characters or of other visible characters, case kept; features are
single words and pairs of neighbours, hashed to 2**bits places (a pair of equal words has a
place of its own, whatever the word). A text is the vector of its feature counts, damped by
a logarithm and scaled to length 1. Training follows the regularised leader (FTRL, one
step size per place) over a bounded sample of labelled rows, in one task, since each update needs
the state that the one before left (averaging shards learned apart leaves the scores uncentred;
``shards`` above one does that). Scores are sparse
dot products through the logistic function, in one pass over the texts without a shuffle.

Bounds, all parameters: ``sample_rows`` labelled rows (those with the smallest hash of
their id) and 2**bits weights. They are all that the driver ever holds.

Defined cases: null is the empty text, whose score comes from the intercept alone; several
labels of one id count as their majority (a tie as 1); ids without a label are only scored;
without labels every score is 0.5; repeated rows are scored each; an empty table gives an
empty result; further columns, whatever their names, are ignored or (``score``) kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymend.llm.common import free_name

WORDS = re.compile(r"\w+|[^\w\s]+")
REMEMBERED = 300_000
PIECE = 1_000_000


class Features:
    """Feature places and weights of a text."""

    def __init__(self, bits: int):
        self.size = 1 << bits
        self.shift = np.uint64(64 - bits)
        self.known: dict[str, int] = {}

    def _words(self, text: str) -> Iterator[np.ndarray]:
        """Hashes of the words; long texts in pieces that share a word with the next one."""
        at, last = 0, []
        while at < len(text) or (at == 0 and not text):
            end = at + PIECE
            while end < len(text) and not text[end].isspace():
                end += 1
            words = WORDS.findall(text[at:end])
            if len(self.known) > REMEMBERED:
                self.known.clear()
            for w in set(words).difference(self.known):
                self.known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
            yield np.concatenate([np.array(last, np.uint64), hashes])
            last = hashes[-1:].tolist() or last
            at = max(end, 1)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct places, and the value at each (their squares add up to 1)."""
        parts, first = [], True
        for h in self._words(text):
            pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
            pair = np.where(h[:-1] == h[1:], np.uint64(0x1234567), pair) * np.uint64(0xD6E8FEB86659FD93)
            parts += [(h if first else h[1:]) >> self.shift, pair >> self.shift]
            first = False
        places, counts = np.unique(np.concatenate(parts), return_counts=True)
        values = np.log1p(counts.astype(np.float64))
        return places.astype(np.int64), values / max(1e-12, np.sqrt((values**2).sum()))


def follow_leader(examples: list[tuple[np.ndarray, np.ndarray, int]], size: int, alpha=1.5, beta=1.0, l1=0.01, l2=0.01, epochs=3) -> np.ndarray:
    """Weights by FTRL-proximal updates; the last place is the intercept, which is not shrunk."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(places):
        at = z[places]
        w = -(at - np.sign(at) * l1) / ((beta + np.sqrt(n[places])) / alpha + l2)
        return np.where(np.abs(at) <= l1, 0.0, w)

    for _ in range(epochs):
        for places, values, label in examples:
            places, values = np.append(places, size), np.append(values, 0.3)
            w = weights(places)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            z[places] += g - (np.sqrt(n[places] + g * g) - np.sqrt(n[places])) / alpha * w
            n[places] += g * g
    return weights(np.arange(size + 1))


def train(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", bits=18,
    sample_rows=24_000, shards=1, seed=17,
) -> np.ndarray:
    """2**bits weights and the intercept, from at most ``sample_rows`` labelled rows.

    Only ids and labels are read to choose the sample; it then meets the texts as a
    broadcast of at most ``sample_rows`` rows.
    """
    voted = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_id")).agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("int").alias("_label"))
    )
    sample = voted.orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(sample), "_id")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(bits)
        for batch in batches:
            made = [features.of(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array([p.astype("<i4").tobytes() for p, _ in made], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary()),
                ],
                names=["id", "label", "places", "values"],
            )

    id_type = dict(docs.dtypes)[id_col]
    vectorised = rows.select("_id", "_text", "_label").mapInArrow(vectors, f"id {id_type}, label int, places binary, values binary")
    dealt = vectorised.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(shards)))

    def learn(pdf):
        import pandas as pd

        # One order whatever the partitions: by the bytes of the vectors.
        pdf = pdf.iloc[np.argsort([xxhash.xxh3_64_intdigest(p + v) for p, v in zip(pdf["places"], pdf["values"], strict=True)], kind="stable")]
        examples = [
            (np.frombuffer(p, "<i4"), np.frombuffer(v, "<f4"), y) for p, v, y in zip(pdf["places"], pdf["values"], pdf["label"], strict=True)
        ]
        w = follow_leader(examples, 1 << bits)
        return pd.DataFrame({"rows": [len(examples)], "weights": [w.astype("<f4").tobytes()]})

    learned = dealt.groupBy("shard").applyInPandas(learn, "rows long, weights binary").collect()  # ``shards`` rows
    if not learned:
        return np.zeros((1 << bits) + 1)
    learned.sort(key=lambda r: (r["rows"], bytes(r["weights"])))
    return np.average([np.frombuffer(r["weights"], "<f4") for r in learned], axis=0, weights=[r["rows"] for r in learned])


def score(docs: DataFrame, weights: np.ndarray, text_col="text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) and ``score``, 0 to 1."""
    kept = docs.columns if keep is None else keep
    size, bits = len(weights) - 1, (len(weights) - 1).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(np.asarray(weights, np.float32))
    base = docs.select(*kept)
    base_names = base.columns
    name = free_name(base, "score")
    hidden = free_name(base, "_text")
    schema = T.StructType([*base.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, w = Features(bits), shared.value.astype(np.float64)
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                dots = []
                for text in part.column(part.num_columns - 1).to_pylist():
                    places, values = features.of(text or "")
                    dots.append(w[places] @ values + 0.3 * w[size])
                scores = 1 / (1 + np.exp(-np.clip(np.array(dots), -35, 35)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(scores)], names=[*base_names, name])

    return docs.select(*kept, F.col(text_col).cast("string").alias(hidden)).mapInArrow(run, schema)
