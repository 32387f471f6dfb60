"""Byte-wise dedup: bytes covered by a string of ``width`` bytes that also starts anywhere else.

Method, a radix sort of suffixes that goes no deeper than ``width`` bytes: suffixes are ordered by
one digit after the other, most significant first, and a suffix that is alone in its group leaves.
What is left in one group after the last digit are the repeated windows.

First digit: ``core`` bytes at a place that the window itself picks (the smallest hash of the
``core``-byte strings in it, the leftmost of equal ones). Equal windows pick the same place, and
neighbouring windows mostly share theirs, so one entry stands for a whole run of neighbouring
windows. Second digit: all bytes of the run's windows. Runs that are equal in it need no more:
every window of theirs is repeated. Runs that share the first digit but not the second go on
to the last digit, where each window is an entry of its own with all of its bytes.

Digits are hashes (64 bits; together 128 or more for whatever counts as equal). Documents are dealt to
batches by a hash of id and text. A batch hands on each distinct entry once, with a mark if
it has it several times, so a passage that a third of all documents share is one entry of each
batch; entries travel as packed arrays, one row for each batch and bucket of digits. The texts are
shuffled once; the plan reads that shuffle three times (two digits, removal).

Defined cases: a null text is empty; texts shorter than ``width`` keep all bytes; repeated rows are
places of their own, so each of them loses what the other has; ids may be null; texts of any
length are worked off in slices; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymend.llm.common import mixed, shuffle_partitions

#: Windows looked at together; bits of a place in such a slice.
SLICE, PLACE_BITS = 1 << 20, 21
#: Two independent polynomial hashes: a random value for each byte, and an odd base.
_RANDOM = np.random.default_rng(20250117)
VALUES = _RANDOM.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + _RANDOM.integers(0, 2, (2, 256), dtype=np.uint64)
BASES = np.array([0xD1342543DE82EF95, 0xA0761D6478BD642F], np.uint64)
#: Verdicts on a run: every window repeated; windows to be compared one by one.
FULL, OPEN = 1, 2


def inverse(odd: int) -> int:
    """Of an odd number, modulo 2**64."""
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of the bases and of their inverses, enough for a slice."""

    def __init__(self, n: int):
        one = np.ones(1, np.uint64)
        self.up = [np.concatenate([one, np.cumprod(np.full(n, b))]) for b in BASES]
        self.down = [np.concatenate([one, np.cumprod(np.full(n, np.uint64(inverse(int(b)))))]) for b in BASES]


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima of blocks from both sides."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


@dataclass
class Slice:
    """Runs of windows of one slice: windows ``first`` to ``last`` (places in the slice) that picked the same core."""

    base: int
    sums: list[np.ndarray]
    powers: Powers
    first: np.ndarray
    last: np.ndarray
    core: np.ndarray
    whole: np.ndarray

    def hashes(self, which: int, at: np.ndarray, size) -> np.ndarray:
        return mixed((self.sums[which][at + size] - self.sums[which][at]) * self.powers.down[which][at])


class Batch:
    """The bytes of the documents of one batch, side by side."""

    def __init__(self, texts: list[str | None], width: int, core: int):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.width, self.core = width, core
        self.sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ends = np.cumsum(self.sizes)
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)

    def slices(self) -> Iterator[Slice]:
        width, core, total = self.width, self.core, len(self.bytes)
        if total < width or not (self.sizes >= width).any():
            return
        powers = Powers(min(total, SLICE + width))
        for base in range(0, total - width + 1, SLICE):
            part = self.bytes[base : base + SLICE + width - 1]
            sums = [
                np.concatenate([np.zeros(1, np.uint64), np.cumsum(VALUES[i][part] * powers.up[i][: len(part)], dtype=np.uint64)]) for i in (0, 1)
            ]
            count = len(part) - width + 1
            # No window reaches into the next document.
            inside = np.ones(count, bool)
            a, b = np.searchsorted(self.ends, [base, base + len(part)], side="right")
            for end in (self.ends[a:b] - base).tolist():
                inside[max(0, end - width + 1) : max(0, end)] = False
            if not inside.any():
                continue
            grams = len(part) - core + 1
            h = mixed((sums[0][core:] - sums[0][:grams]) * powers.down[0][:grams])
            places = np.uint64((1 << PLACE_BITS) - 1)
            picked = (sliding_least((h & ~places) | np.arange(grams, dtype=np.uint64), width - core + 1) & places).astype(np.int64)
            at = np.flatnonzero(inside)
            new = np.append(True, (picked[at][1:] != picked[at][:-1]) | (np.diff(at) > 1))
            first = at[new]
            last = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
            where = picked[first]
            made = Slice(base, sums, powers, first, last, h[where], np.empty(0, np.uint64))
            size = last - first + width
            shape = ((where - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
            made.whole = mixed(made.hashes(0, first, size) ^ mixed(made.hashes(1, first, size) + shape))
            yield made


def windows_of(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All places from first to last, of each run."""
    sizes = last - first + 1
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


def distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one entry of each distinct (high, low), sorted, and whether it occurs several times."""
    order = np.lexsort((low, high))
    a, b = high[order], low[order]
    starts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.empty(0, np.int64)
    return order[starts], np.diff(np.append(starts, len(a))) > 1


def by_part(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(part, indices), each part's in their order."""
    if not len(part):
        return
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.append(True, part[order][1:] != part[order][:-1]))
    for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True):
        yield int(part[order[a]]), order[a:b]


ENTRIES = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("high", pa.binary()), ("low", pa.binary()), ("several", pa.binary())])
VERDICTS = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("runs", pa.binary()), ("states", pa.binary()), ("windows", pa.binary())])
ENTRIES_SQL = "bucket int, batch int, high binary, low binary, several binary"
VERDICTS_SQL = "batch int, bucket int, runs binary, states binary, windows binary"


def entries(batch: int, high: np.ndarray, low: np.ndarray, buckets: int) -> pa.Table:
    """Packed distinct entries, one row for each bucket of ``high``."""
    pick, several = distinct(high, low)
    high, low = high[pick], low[pick]
    rows = [
        {"bucket": b, "batch": batch, "high": high[own].tobytes(), "low": low[own].tobytes(), "several": np.packbits(several[own]).tobytes()}
        for b, own in by_part(((high >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
    ]
    return pa.Table.from_pylist(rows, ENTRIES)


def unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """high, low, several and the row of every packed entry."""
    high = [np.frombuffer(x, np.uint64) for x in table["high"].to_pylist()]
    low = [np.frombuffer(x, np.uint64) for x in table["low"].to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, np.uint8))[: len(h)] for x, h in zip(table["several"].to_pylist(), high, strict=True)]
    return np.concatenate(high), np.concatenate(low), np.concatenate(several).astype(bool), np.repeat(np.arange(len(high)), [len(h) for h in high])


def groups(sorted_keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Start of each group of equal neighbours, and the group of every entry."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[0] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def judge_runs(table: pa.Table) -> pa.Table:
    """First and second digit of one bucket: the runs that go on or are settled."""
    core, whole, several, source = unpacked(table)
    order = np.lexsort((source, whole, core))
    core, whole, several, source = core[order], whole[order], several[order], source[order]
    starts, group = groups([core, whole])
    times = np.add.reduceat(1 + several.astype(np.int64), starts)
    full = (times > 1)[group]
    core_starts, core_group = groups([core])
    shared = (np.add.reduceat(np.isin(np.arange(len(core)), starts).astype(np.int64), core_starts) > 1)[core_group]
    # Of equal runs one batch compares the windows for all.
    lead = np.zeros(len(core), bool)
    lead[starts] = True
    state = FULL * full + OPEN * (shared & (lead | ~full))
    at = np.flatnonzero(state)
    batches, buckets = table["batch"].to_pylist(), table["bucket"].to_pylist()
    rows = [
        {"batch": batches[i], "bucket": buckets[i], "runs": whole[at[own]].tobytes(), "states": state[at[own]].astype(np.uint8).tobytes(), "windows": None}
        for i, own in by_part(source[at])
    ]
    return pa.Table.from_pylist(rows, VERDICTS)


def judge_windows(table: pa.Table) -> pa.Table:
    """Last digit of one bucket: the windows that occur several times."""
    high, low, several, source = unpacked(table)
    order = np.lexsort((low, high))
    starts, group = groups([high[order], low[order]])
    repeated = np.empty(len(high), bool)
    repeated[order] = (np.add.reduceat(1 + several[order].astype(np.int64), starts) > 1)[group]
    at = np.flatnonzero(repeated)
    batches, buckets = table["batch"].to_pylist(), table["bucket"].to_pylist()
    rows = [
        {"batch": batches[i], "bucket": buckets[i], "runs": None, "states": None, "windows": high[at[own]].tobytes()}
        for i, own in by_part(source[at])
    ]
    return pa.Table.from_pylist(rows, VERDICTS)


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.empty(0, kind), *[np.frombuffer(x, kind) for x in column.to_pylist() if x is not None]])


def state_of(whole: np.ndarray, runs: np.ndarray, states: np.ndarray) -> np.ndarray:
    """The verdict on each run, 0 for none. ``runs`` are sorted."""
    if not len(runs):
        return np.zeros(len(whole), np.uint8)
    at = np.minimum(np.searchsorted(runs, whole), len(runs) - 1)
    return np.where(runs[at] == whole, states[at], 0).astype(np.uint8)


def byte_dedup(
    docs: DataFrame, id_col="doc_id", text_col="text", width: int = 400, core: int = 256, batch_chars: int = 8_000_000,
    bucket_entries: int = 2_000_000,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, removed (spans of bytes)."""
    spark = docs.sparkSession
    core = min(core, width)
    chars = docs.agg(F.sum(F.length(F.col(text_col).cast("string")))).first()[0] or 0
    # Batches grow with the table, up to what a task holds with ease.
    batches = max(1, shuffle_partitions(spark), -(-chars // min(max(batch_chars, chars // 20_000), 8 * batch_chars)))
    buckets = max(1, shuffle_partitions(spark), 2 * chars // (width - core + 1) // bucket_entries)
    id_type = docs.schema[id_col].dataType
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(batches)).cast("int").alias("batch"), F.col(id_col).alias("doc"),
        F.col(text_col).cast("string").alias("text"),
    ).repartition(min(batches, 20_000), "batch")

    def runs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = [(s.core, s.whole) for s in Batch(table["text"].to_pylist(), width, core).slices()]
        if not parts:
            return ENTRIES.empty_table()
        return entries(key[0].as_py(), *(np.concatenate(x) for x in zip(*parts, strict=True)), buckets)

    def windows(key: tuple[pa.Scalar, ...], table: pa.Table, verdicts: pa.Table) -> pa.Table:
        known, states = joined(verdicts["runs"], np.uint64), joined(verdicts["states"], np.uint8)
        order = np.argsort(known)
        known, states = known[order], states[order]
        if not table.num_rows or not (states & OPEN).any():
            return ENTRIES.empty_table()
        parts, done = [], np.empty(0, np.uint64)
        for s in Batch(table["text"].to_pylist(), width, core).slices():
            state = state_of(s.whole, known, states)
            at = np.flatnonzero(state & OPEN)
            # Of equal runs one is enough: they are settled, and only stand for the others.
            at = at[np.unique(s.whole[at], return_index=True)[1]]
            at = at[~np.isin(s.whole[at], done)]
            done = np.concatenate([done, s.whole[at]])
            places = windows_of(s.first[at], s.last[at])
            parts.append((s.hashes(0, places, width), s.hashes(1, places, width)))
        if not parts:
            return ENTRIES.empty_table()
        return entries(key[0].as_py(), *(np.concatenate(x) for x in zip(*parts, strict=True)), buckets)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"]

    def remove(key: tuple[pa.Scalar, ...], table: pa.Table, verdicts: pa.Table) -> pa.Table:
        batch = Batch(table["text"].to_pylist(), width, core)
        known, states = joined(verdicts["runs"], np.uint64), joined(verdicts["states"], np.uint8)
        order = np.argsort(known)
        known, states = known[order], states[order]
        repeated = np.sort(joined(verdicts["windows"], np.uint64))
        edges = np.zeros(len(batch.bytes) + 1, np.int32)
        for s in batch.slices() if len(known) else ():
            state = state_of(s.whole, known, states)
            at = np.flatnonzero(state & FULL)
            np.add.at(edges, s.base + s.first[at], 1)
            np.add.at(edges, s.base + s.last[at] + width, -1)
            at = np.flatnonzero(state == OPEN)
            if len(at) and len(repeated):
                places = windows_of(s.first[at], s.last[at])
                h = s.hashes(0, places, width)
                found = places[repeated[np.minimum(np.searchsorted(repeated, h), len(repeated) - 1)] == h]
                np.add.at(edges, s.base + found, 1)
                np.add.at(edges, s.base + found + width, -1)
        gone = np.cumsum(edges[:-1]) > 0
        removed, spans, digests = [], [], []
        for end, size in zip(batch.ends.tolist(), batch.sizes.tolist(), strict=True):
            cut = gone[end - size : end]
            own = batch.bytes[end - size : end]
            if cut.any():
                spans.append(np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]]))).reshape(-1, 2).tolist())
                own = own[~cut]
            else:
                spans.append([])
            removed.append(size - len(own))
            digests.append(hashlib.sha256(own.tobytes()).hexdigest())
        columns = [
            table["doc"], pa.array(batch.sizes), pa.array(removed, pa.int64()), pa.array([len(x) for x in spans], pa.int64()),
            pa.array(digests, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
        ]
        return pa.Table.from_arrays(columns, names=names)

    long = T.LongType()
    schema = T.StructType([
        T.StructField(id_col, id_type), *[T.StructField(n, long) for n in names[1:4]], T.StructField(names[4], T.StringType()),
        T.StructField(names[5], T.ArrayType(T.ArrayType(long))),
    ])
    by_run = dealt.groupBy("batch").applyInArrow(runs, ENTRIES_SQL).groupBy("bucket").applyInArrow(judge_runs, VERDICTS_SQL)
    by_window = (
        dealt.groupBy("batch").cogroup(by_run.groupBy("batch")).applyInArrow(windows, ENTRIES_SQL)
        .groupBy("bucket").applyInArrow(judge_windows, VERDICTS_SQL)
    )
    verdicts = by_run.unionByName(by_window)
    return dealt.groupBy("batch").cogroup(verdicts.groupBy("batch")).applyInArrow(remove, schema)
