"""Substring dedup: words covered by a passage that an earlier document has as well.

A window is ``window`` consecutive words. A word goes when a window over it also starts in a
document with a smaller id.

Method, fixed-block anchors: (1) every document is cut into non-overlapping blocks of
``block`` words, few enough that any window holds a whole one; the hashes of these blocks are
the index, and the hashes of all rolling runs of ``block`` words probe it. (2) Around each hit
the windows that hold the anchor are compared by a 128-bit hash of their words; the smallest
id that has a window decides. Overlapping windows grow together to the maximal repeats.

Documents are dealt to batches by a hash of their id. What leaves a batch is one entry for
each distinct hash it holds, never one for each document, so a passage that a third of all
documents share is one entry per batch, and no pairs of documents are made. Entries travel
as packed arrays, one row per batch and bucket of hashes. The batches are shuffled once; the
plan reads that shuffle three times (probes, windows, removal).

Defined cases: a null text has no words; documents shorter than a window keep all words;
of rows that repeat an id none is smaller than the other; rows without an id keep all words
and remove none; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.llm.common import shuffle_partitions, window_hashes, word_hashes, word_pieces

NO_DOC = np.iinfo(np.int64).max


class Batch:
    """Word hashes of the documents of one batch, side by side."""

    def __init__(self, docs: pd.DataFrame):
        docs = docs.sort_values("doc", kind="stable", na_position="last")
        self.ids = docs["doc"].tolist()
        self.texts = docs["text"].tolist()
        hashes = [word_hashes(t) for t in self.texts]
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        self.words = np.concatenate([np.empty(0, np.uint64), *hashes])
        self.starts = np.cumsum(self.sizes) - self.sizes
        owner = np.repeat(np.arange(len(self.ids)), self.sizes)
        known = np.array([not pd.isna(i) for i in self.ids], bool)
        ids = np.array([NO_DOC if pd.isna(i) else int(i) for i in self.ids], np.int64)
        self.owner, self.known, self.doc = owner, known[owner], ids[owner]
        self.place = np.arange(len(owner)) - self.starts[owner]

    def runs(self, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions where ``width`` words of one document (with an id) start, and their hashes."""
        h = window_hashes(self.words, width, seed)
        inside = (self.owner[: len(h)] == self.owner[width - 1 :][: len(h)]) & self.known[: len(h)]
        at = np.flatnonzero(inside)
        return at, h[at]


def _blocks(batch: Batch, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct run of ``block`` words: hash, whether it is a reference block, whether
    several documents of the batch have it; and position and hash of all runs."""
    at, h = batch.runs(block, 0)
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    starts = np.flatnonzero(np.append(True, sorted_h[1:] != sorted_h[:-1])) if len(h) else np.empty(0, int)
    reference = np.logical_or.reduceat(batch.place[at[order]] % block == 0, starts) if len(h) else np.empty(0, bool)
    owner = batch.owner[at[order]]
    several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts) if len(h) else np.empty(0, bool)
    return sorted_h[starts], reference, several, np.stack([at, h.view(np.int64)])


def _bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of fixed-width values, all first bytes first: sorted values pack better so."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_planes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
    for a, b in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def substring_dedup(docs: DataFrame, id_col="doc_id", text_col="text", window: int = 13, batch_chars: int = 8_000_000) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, removed (spans of words)."""
    block = (window + 1) // 2
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length(F.col(text_col).cast("string")))).first()[0] or 0
    batches = max(1, shuffle_partitions(spark), -(-chars // batch_chars))
    buckets = max(shuffle_partitions(spark), batches // 2)
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), F.lit(batches)).cast("int").alias("batch"),
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"),
    ).repartition(batches, "batch")

    def probes(pdf: pd.DataFrame) -> pd.DataFrame:
        h, reference, several, _ = _blocks(Batch(pdf), block)
        # 32 bits within the bucket; a chance hit only costs a comparison of windows.
        low = h.astype(np.uint32)
        rows = []
        for bucket, at in _by_bucket(_bucket_of(h, buckets)):
            at = at[np.argsort(low[at], kind="stable")]
            flags = reference[at] + 2 * several[at].astype(np.uint8)
            rows.append((bucket, int(pdf["batch"].iloc[0]), _planes(low[at]), np.packbits(flags.astype(np.uint8) & 1).tobytes(), np.packbits(flags >> 1).tobytes()))
        return pd.DataFrame(rows, columns=["bucket", "batch", "hashes", "reference", "several"])

    def matches(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [_from_planes(r, np.uint32) for r in pdf["hashes"]]
        sizes = [len(p) for p in parts]
        h = np.concatenate(parts)
        reference, several = (
            np.concatenate([np.unpackbits(np.frombuffer(r, np.uint8))[:n] for r, n in zip(pdf[c], sizes, strict=True)]).astype(bool)
            for c in ("reference", "several")
        )
        source = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(h, kind="stable")
        starts = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
        counts = np.diff(np.append(starts, len(h)))
        hit = np.logical_or.reduceat(reference[order], starts) & ((counts > 1) | np.logical_or.reduceat(several[order], starts))
        chosen = np.zeros(len(h), bool)
        chosen[order] = np.repeat(hit, counts)
        rows = []
        at = np.flatnonzero(chosen)
        for i, own in _by_bucket(source[at]):
            rows.append((int(pdf["batch"].iloc[i]), int(pdf["bucket"].iloc[i]), _planes(h[at[own]])))
        return pd.DataFrame(rows, columns=["batch", "bucket", "hashes"])

    def windows(key, pdf: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame([], columns=["bucket", "batch", "high", "low", "docs"])
        if not len(pdf) or not len(hits):
            return empty
        batch = Batch(pdf)
        at, h = batch.runs(block, 0)
        anchored = np.zeros(len(batch.words) + window, bool)
        bucket, low = _bucket_of(h, buckets), h.astype(np.uint32)
        wanted = {b: np.concatenate([_from_planes(x, np.uint32) for x in g]) for b, g in hits.groupby("bucket")["hashes"]}
        for b, own in _by_bucket(bucket):
            if b in wanted:
                anchored[at[own[np.isin(low[own], wanted[b])]]] = True
        # A window is compared when a block that starts in it lies inside it.
        count = np.concatenate([[0], np.cumsum(anchored)])
        starts, high = batch.runs(window, 1)
        use = count[starts + window - block + 1] > count[starts]
        starts, high = starts[use], high[use]
        if not len(starts):
            return empty
        low = window_hashes(batch.words, window, 2)[starts]
        # The smallest id of the batch that has the window.
        order = np.lexsort((batch.doc[starts], low, high))
        first = np.append(True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1]))
        pick = order[first]
        pick = pick[np.argsort(starts[pick], kind="stable")]
        rows = [
            (b, int(pdf["batch"].iloc[0]), high[pick[own]].tobytes(), low[pick[own]].tobytes(), batch.doc[starts[pick[own]]].tobytes())
            for b, own in _by_bucket(_bucket_of(high[pick], buckets))
        ]
        return pd.DataFrame(rows, columns=["bucket", "batch", "high", "low", "docs"])

    def earliest(pdf: pd.DataFrame) -> pd.DataFrame:
        high = np.concatenate([np.frombuffer(r, np.uint64) for r in pdf["high"]])
        low = np.concatenate([np.frombuffer(r, np.uint64) for r in pdf["low"]])
        parts = [np.frombuffer(r, np.int64) for r in pdf["docs"]]
        doc, source = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        order = np.lexsort((doc, low, high))
        first = np.append(True, (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1]))
        least = np.empty(len(doc), np.int64)
        least[order] = doc[order][np.flatnonzero(first)[np.cumsum(first) - 1]]
        at = np.flatnonzero(least < doc)
        rows = [
            (int(pdf["batch"].iloc[i]), high[at[own]].tobytes(), low[at[own]].tobytes(), least[at[own]].tobytes())
            for i, own in _by_bucket(source[at])
        ]
        return pd.DataFrame(rows, columns=["batch", "high", "low", "least"])

    def remove(key, pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame([], columns=[id_col, "n_words", "n_removed", "kept_sha256", "removed"])
        batch = Batch(pdf)
        starts, high = batch.runs(window, 1)
        low = window_hashes(batch.words, window, 2)[starts]
        own = batch.doc[starts]
        join = lambda c, t: np.concatenate([np.empty(0, t), *[np.frombuffer(r, t) for r in found[c]]])
        all_high, all_low = np.concatenate([high, join("high", np.uint64)]), np.concatenate([low, join("low", np.uint64)])
        all_doc = np.concatenate([own, join("least", np.int64)])
        order = np.lexsort((all_doc, all_low, all_high))
        covered = np.zeros(len(batch.words) + 1, np.int64)
        if len(order):
            sh, sl = all_high[order], all_low[order]
            first = np.append(True, (sh[1:] != sh[:-1]) | (sl[1:] != sl[:-1]))
            least = np.empty(len(order), np.int64)
            least[order] = all_doc[order][np.flatnonzero(first)[np.cumsum(first) - 1]]
            gone = starts[least[: len(starts)] < own]
            np.add.at(covered, gone, 1)
            np.add.at(covered, gone + window, -1)
        covered = np.cumsum(covered)[:-1] > 0
        rows = []
        for i, text in enumerate(batch.texts):
            a, n = int(batch.starts[i]), int(batch.sizes[i])
            cut = covered[a : a + n]
            words = chain.from_iterable(word_pieces(text))
            digest = hashlib.sha256()
            if cut.any():
                digest.update(b" ".join(w for w, c in zip(words, cut.tolist(), strict=True) if not c))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
                spans = edges.reshape(-1, 2).tolist()
            else:
                digest.update(b" ".join(words))
                spans = []
            rows.append((None if pd.isna(batch.ids[i]) else int(batch.ids[i]), n, int(cut.sum()), digest.hexdigest(), spans))
        out = pd.DataFrame(rows, columns=[id_col, "n_words", "n_removed", "kept_sha256", "removed"])
        out[id_col] = out[id_col].astype("Int64")
        return out

    probed = dealt.groupBy("batch").applyInPandas(probes, "bucket int, batch int, hashes binary, reference binary, several binary")
    hits = probed.groupBy("bucket").applyInPandas(matches, "batch int, bucket int, hashes binary")
    compared = dealt.groupBy("batch").cogroup(hits.groupBy("batch")).applyInPandas(
        windows, "bucket int, batch int, high binary, low binary, docs binary"
    )
    least = compared.groupBy("bucket").applyInPandas(earliest, "batch int, high binary, low binary, least binary")
    schema = f"{id_col} long, n_words long, n_removed long, kept_sha256 string, removed array<array<long>>"
    return dealt.groupBy("batch").cogroup(least.groupBy("batch")).applyInPandas(remove, schema)
