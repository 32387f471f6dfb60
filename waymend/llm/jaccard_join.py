"""N-gram Jaccard join: which texts share at least a given part of their word shingles.

A text is the set of its distinct shingles (64-bit hashes of ``width`` consecutive words,
A-Z in lower case). Texts with the same set are one class; everything below works on
classes. Two sets that are similar enough share one of the first few shingles of each, in any
order of shingles that is the same for all; tiles are the classes that share such a shingle.

Order: shingles that occur often (found by counting those that repeat within a block of
texts; the ``most_hot`` most frequent ones are kept) come last, so a passage that a third of
all texts share makes no tile. The order decides the work, never the result.

In a tile, classes are sorted by size; each meets only the band of sizes that the similarity
allows. A parity bitmap of each class (its width follows the size) bounds the overlap from
above: every bit that differs is at least one shingle that only one of the two has. Pairs
that pass are compared exactly by their sorted arrays.

First each class meets the first and the next one of its tile. The classes that these links
join are one component; then only pairs of different components are compared, inside their
tile and with wider bitmaps, and what is found joins components at once: a tile hands on at
most one link per row, so a large group of near copies does not become all its pairs. Tiles
beyond ``tile_rows`` are cut into blocks, and each pair of blocks is a tile of its own.

Defined cases: a null text or one without words has an empty set and is linked with nothing;
with fewer words than ``width`` the whole sequence is the one shingle; rows without an id take
no part in links (component null); rows that repeat an id count as one node, whatever their
texts: a link of any of them joins all, one without words included; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.llm.common import staged, window_hashes, word_hashes
from waymend.llm.components import components


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not len(words):
        return np.empty(0, np.uint64)
    h = np.sort(window_hashes(words, min(width, len(words))))
    return h[np.append(True, h[1:] != h[:-1])]


#: Bits for each shingle: few for the first look at all tiles, more for the open ones.
NARROW, WIDE = 0.5, 4


def bitmap_bits(n: int, share: float) -> int:
    """Width for a set of n shingles, a power of two."""
    return 1 << min(13, max(6, (int(max(n, 2) * share) - 1).bit_length()))


def bitmap(shingles: np.ndarray, share: float = NARROW) -> bytes:
    """Parity of the shingles at each bit. Half the width is the xor of both halves."""
    bits = bitmap_bits(len(shingles), share)
    places = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8)).tobytes()


def least_overlap(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Shingles that a set of n must share with any set it is linked with."""
    return -(-n * num // den)


def fitting(a_n, b_n, apart, num: int, den: int):
    """Whether sizes and the number of differing bits still allow the similarity."""
    both = a_n + b_n
    # overlap <= (both - apart) / 2, and union = both - overlap
    return (both - apart) * den >= num * (both + apart)


def key_of(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _scan(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc, n, key, bits for every row; hot, times for shingles that repeat within a block."""
    id_type = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, n, keys, bits, wide, seen = [], [], [], [], [], set()
            for text in batch.column(1).to_pylist():
                s = shingle_set(word_hashes(text, lower=True), width)
                n.append(len(s))
                keys.append(key_of(s))
                bits.append(bitmap(s))
                wide.append(bitmap(s, WIDE))
                if keys[-1] not in seen:
                    seen.add(keys[-1])
                    sets.append(s)
            shingles, times = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0, int))
            often = times >= 4
            rows, more = batch.num_rows, int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(more, batch.column(0).type)]),
                    pa.array(n + [None] * more, pa.int32()), pa.array(keys + [None] * more, pa.binary()),
                    pa.array(bits + [None] * more, pa.binary()), pa.array(wide + [None] * more, pa.binary()),
                    pa.array([None] * rows + shingles[often].view(np.int64).tolist(), pa.int64()),
                    pa.array([None] * rows + times[often].tolist(), pa.int64()),
                ],
                names=["doc", "n", "key", "bits", "wide", "hot", "times"],
            )

    picked = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return picked.mapInArrow(run, f"doc {id_type}, n int, key binary, bits binary, wide binary, hot long, times long")


def _prefixes(docs: DataFrame, text_col: str, width: int, num: int, den: int, hot: np.ndarray) -> DataFrame:
    """token, key, n: the first shingles of every set in the common order."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(hot)  # at most most_hot numbers, the rarest first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = shared.value
        order = np.argsort(hot)
        sorted_hot = hot[order]
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                tokens, keys, sizes, last = [], [], [], set()
                for text in batch.column(0).slice(start, 2048).to_pylist():
                    s = shingle_set(word_hashes(text, lower=True), width)
                    if not len(s) or (key := key_of(s)) in last:
                        continue
                    last.add(key)
                    n = len(s)
                    first = n - int(least_overlap(n, num, den)) + 1
                    if len(sorted_hot):
                        at = np.minimum(np.searchsorted(sorted_hot, s), len(sorted_hot) - 1)
                        is_hot = sorted_hot[at] == s
                        cold = s[~is_hot]
                        if len(cold) < first:
                            cold = np.concatenate([cold, s[is_hot][np.argsort(order[at[is_hot]])]])
                        s = cold
                    tokens.append(s[:first])
                    keys.append(key)
                    sizes.append(n)
                counts = [len(t) for t in tokens]
                if not counts:
                    continue
                index = np.repeat(np.arange(len(keys)), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(keys, pa.binary()).take(pa.array(index)), pa.array(np.array(sizes, np.int32)[index]),
                    ],
                    names=["token", "key", "n"],
                )

    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, "token long, key binary, n int")


def _shared(prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """Rows whose token another class of a fitting size has as well (each class once)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_fits = None, False  # the last row waits for the one behind it
        for batch in batches:
            table = pa.Table.from_batches(([held] if held is not None else []) + [batch]).combine_chunks()
            if not table.num_rows:
                continue
            token, n = table["token"].to_numpy(), table["n"].to_numpy().astype(np.int64)
            keys = table["key"].combine_chunks() if isinstance(table["key"], pa.ChunkedArray) else table["key"]
            raw = np.frombuffer(b"".join(keys.to_pylist()), "<u8").reshape(-1, 2)
            fresh = np.append(True, (token[1:] != token[:-1]) | (raw[1:] != raw[:-1]).any(1))
            at = np.flatnonzero(fresh)
            token, n = token[at], n[at]
            next_fits = (token[1:] == token[:-1]) & (n[:-1] * den >= num * n[1:])
            before = np.append(held_fits, next_fits)
            keep = before.copy()
            keep[:-1] |= next_fits
            out = table.take(pa.array(at[:-1][keep[:-1]]))
            yield from out.combine_chunks().to_batches()
            held, held_fits = table.take(pa.array(at[-1:])).combine_chunks().to_batches()[0], bool(before[-1])
        if held is not None and held_fits:
            yield held

    by_token = prefixes.repartition("token").sortWithinPartitions("token", "n", "key")
    return by_token.mapInArrow(run, prefixes.schema)


def apart(bits_a: list[bytes], bits_b: list[bytes]) -> np.ndarray:
    """Differing bits of each pair; the wider bitmap is folded to the narrower one."""
    la, lb = np.fromiter(map(len, bits_a), int, len(bits_a)), np.fromiter(map(len, bits_b), int, len(bits_b))
    out = np.zeros(len(la), np.int64)
    for wa, wb in {*zip(la.tolist(), lb.tolist(), strict=True)}:
        at = np.flatnonzero((la == wa) & (lb == wb))
        x = folded(np.frombuffer(b"".join(bits_a[i] for i in at), np.uint8).reshape(len(at), wa), min(wa, wb))
        y = folded(np.frombuffer(b"".join(bits_b[i] for i in at), np.uint8).reshape(len(at), wb), min(wa, wb))
        out[at] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def folded(rows: np.ndarray, width: int) -> np.ndarray:
    while rows.shape[1] > width:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


PAIR = "a long, b long"


def _first_pairs(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of each class with the first and the next one of its tile that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = last = None  # (token, cls, n, bits)
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            lead = [r for r in (head, last) if r is not None]
            for i, column in enumerate(columns):
                columns[i] = [r[i] for r in lead] + column
            token, cls, n, bits = columns
            token, sizes, ids = np.array(token, np.int64), np.array(n, np.int64), np.array(cls, np.int64)
            rows = np.arange(len(lead), len(token))
            if not len(rows):
                continue
            starts = np.append(True, token[1:] != token[:-1])
            first = np.maximum.accumulate(np.where(starts, np.arange(len(token)), 0))
            left = np.concatenate([first[rows], rows[rows > 0] - 1])
            right = np.concatenate([rows, rows[rows > 0]])
            use = (left < right) & (token[left] == token[right]) & (ids[left] != ids[right]) & (sizes[left] * den >= num * sizes[right])
            pairs = np.unique(np.column_stack([left[use], right[use]]), axis=0)
            a, b = pairs[:, 0], pairs[:, 1]
            if len(a):
                far = apart([bits[i] for i in a], [bits[i] for i in b])
                ok = fitting(sizes[a], sizes[b], far, num, den)
                x, y = ids[a[ok]], ids[b[ok]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])
            head, last = [tuple(c[i] for c in columns) for i in (first[-1], len(token) - 1)]

    by_token = tiles.repartition("token").sortWithinPartitions("token", "n", "cls")
    return by_token.select("token", "cls", "n", "bits").mapInArrow(run, PAIR).distinct()


def near_pairs(n: np.ndarray, bits: list[bytes], apart_from: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i < j) of rows sorted by size that may be similar and differ in ``apart_from``."""
    width = np.fromiter(map(len, bits), int, len(bits))
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        near = np.flatnonzero(width >= w)  # larger ones come behind
        packed = np.empty((len(near), w // 8), np.uint64)
        for v in np.unique(width[near]):
            at = np.flatnonzero(width[near] == v)
            packed[at] = np.ascontiguousarray(folded(np.frombuffer(b"".join(bits[k] for k in near[at]), np.uint8).reshape(len(at), v), w)).view(np.uint64)
        place = np.searchsorted(near, own)
        for start in range(0, len(own), 64):
            some, at = own[start : start + 64], place[start : start + 64]
            stop = int(np.searchsorted(n[near], n[some].max() * den // num, side="right"))
            begin = int(at[0])
            far = np.zeros((len(some), stop - begin), np.int64)
            for k in range(packed.shape[1]):
                far += np.bitwise_count(packed[at, k][:, None] ^ packed[begin:stop, k][None])
            b = near[begin:stop]
            ok = fitting(n[some][:, None], n[b][None], far, num, den) & (some[:, None] < b[None])
            ok &= apart_from[some][:, None] != apart_from[b][None]
            x, y = np.nonzero(ok)
            if len(x):
                yield some[x], b[y]


def similar(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """Exact: two sorted arrays without repeats."""
    both = np.sort(np.concatenate([x, y]), kind="stable")
    overlap = int((both[1:] == both[:-1]).sum())
    return den * overlap >= num * (len(x) + len(y) - overlap)


def link_tile(n: np.ndarray, component: np.ndarray, bits: list[bytes], sets: list[bytes], num: int, den: int) -> list[tuple[int, int]]:
    """Links between rows of different components, until none is left that would join two."""
    links, joined = [], {c: c for c in component.tolist()}

    def root(c):
        while joined[c] != c:
            joined[c] = c = joined[joined[c]]
        return c

    for left, right in near_pairs(n, bits, component, num, den):
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            a, b = root(int(component[i])), root(int(component[j]))
            if a != b and similar(np.frombuffer(sets[i], np.uint64), np.frombuffer(sets[j], np.uint64), num, den):
                joined[max(a, b)] = min(a, b)
                links.append((i, j))
    return links


def _tiles_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Rows of each tile (equal first ``keys`` columns) of sorted batches."""
    tile, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        ends = [k for k in range(1, batch.num_rows) if any(c[k] != c[k - 1] for c in columns[:keys])]
        for a, b in zip([0, *ends], [*ends, batch.num_rows], strict=True):
            if a == b:
                continue
            if (now := tuple(c[a] for c in columns[:keys])) != tile:
                if tile is not None:
                    yield tile, held
                tile, held = now, [[] for _ in columns[keys:]]
            for own, c in zip(held, columns[keys:], strict=True):
                own += c[a:b]
    if tile is not None:
        yield tile, held


def _open_rows(tiles: DataFrame, classes: DataFrame, labels: DataFrame, num: int, den: int, tile_rows: int) -> DataFrame:
    """(token, i, j, cls, component, n, wide): rows of a tile that may be similar to one of another component.

    Tiles of up to three rows, and tiles within one component, are done already.
    """
    labelled = tiles.select("token", "cls", "n").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls")
    )
    open_ = labelled.groupBy("token").agg(
        F.count(F.lit(1)).alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("rows > 3 and low <> high").select("token", F.ceil(F.col("rows") / tile_rows).cast("int").alias("blocks"))
    placed = labelled.join(open_, "token").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.withColumn("other", other).join(classes.select("cls", "wide"), "cls").select(
        "token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "n", "cls", "component", "wide"
    )

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, (n, cls, component, wide) in _tiles_of(batches, 3):
            sizes, groups = np.array(n, np.int64), np.array(component, np.int64)
            on = np.zeros(len(n), bool)
            for left, right in near_pairs(sizes, wide, groups, num, den):
                on[left] = on[right] = True
            at = np.flatnonzero(on)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tile[0]] * len(at), pa.int64()), pa.array([tile[1]] * len(at), pa.int32()), pa.array([tile[2]] * len(at), pa.int32()),
                        pa.array(np.array(cls, np.int64)[at]), pa.array(groups[at]), pa.array(sizes[at].astype(np.int32)),
                        pa.array([wide[k] for k in at], pa.binary()),
                    ],
                    names=["token", "i", "j", "cls", "component", "n", "wide"],
                )

    by_tile = placed.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "cls")
    return by_tile.mapInArrow(active, "token long, i int, j int, cls long, component long, n int, wide binary")


def _late_links(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links between different components in the tiles of ``_open_rows``, compared exactly.

    Tiles with the same rows (a family shares many shingles) are worked off once.
    """
    tile = ["token", "i", "j"]
    same = rows.groupBy(*tile).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("a"),
        F.sum(F.xxhash64(F.lit(1), "cls").cast("decimal(38,0)")).alias("b"),
    ).groupBy("rows", "a", "b").agg(F.min(F.struct(*tile)).alias("t")).select("t.*")
    full = rows.join(same, tile, "left_semi").join(sets, "cls").select(*tile, "n", "cls", "component", "wide", "shingles")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (n, cls, component, wide, shingles) in _tiles_of(batches, 3):
            pairs = link_tile(np.array(n, np.int64), np.array(component, np.int64), wide, shingles, num, den)
            if pairs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls[i] for i, _ in pairs], pa.int64()), pa.array([cls[j] for _, j in pairs], pa.int64())], names=["a", "b"]
                )

    by_tile = full.repartition(*tile).sortWithinPartitions(*tile, "n", "cls")
    return by_tile.mapInArrow(link, PAIR).distinct()


def _sets(ids: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(cls, shingles): the sorted sets of the classes in ``ids``, made of the texts again."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                sets = [shingle_set(word_hashes(t, lower=True), width) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(map(key_of, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["cls", "key", "shingles"],
                )

    wanted = docs.select(F.col(id_col).cast("long").alias("cls"), F.col(text_col).cast("string").alias("_text")).join(
        ids.select("cls").distinct().hint("shuffle_hash"), "cls", "left_semi"
    )
    sets = wanted.mapInArrow(sets_of, "cls long, key binary, shingles binary")
    # Only the set of the class itself, once, where an id has several rows.
    own = sets.join(classes.select("cls", "key"), ["cls", "key"], "left_semi").dropDuplicates(["cls", "key"])
    return staged(own.select("cls", "shingles"))


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets are similar enough: sorted arrays, intersected exactly."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), num, den)
                for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    first = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a")
    both = first.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(check, PAIR)


def _repeated_ids(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a: class, b: id) for every set of the ids that occur with several sets."""
    named = rows.where("doc is not null").select(F.col("doc").cast("long").alias("b"), "key")
    several = named.groupBy("b").agg(F.min(F.xxhash64("key")).alias("low"), F.max(F.xxhash64("key")).alias("high")).where("low <> high")
    held = named.join(several.select("b"), "b", "left_semi").distinct()
    return held.join(classes.select("key", F.col("cls").alias("a")), "key").select("a", "b").distinct()


def jaccard_join(
    docs: DataFrame, id_col="doc_id", text_col="text", width: int = 4, similarity: tuple[int, int] = (85, 100),
    tile_rows: int = 2048, most_hot: int = 100_000,
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links)."""
    num, den = similarity
    scan = staged(_scan(docs, id_col, text_col, width))
    rows = scan.where("key is not null")
    hot = scan.where("hot is not null").groupBy("hot").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "hot").limit(most_hot)
    frequent = hot.toPandas().sort_values(["times", "hot"])["hot"].to_numpy(np.int64).view(np.uint64)
    classes = staged(
        rows.where("n > 0 and doc is not null").groupBy("key").agg(
            F.min(F.col("doc").cast("long")).alias("cls"), F.min("n").alias("n"), F.min("bits").alias("bits"), F.min("wide").alias("wide")
        )
    )
    shared = _shared(_prefixes(docs, text_col, width, num, den, frequent), num, den)
    tiles = staged(shared.select("token", "key").join(classes, "key").select("token", "cls", "n", "bits"))
    pairs = staged(_first_pairs(tiles, num, den))
    ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls")))
    links = _verified(pairs, _sets(ends, docs, classes, id_col, text_col, width), num, den)
    repeated = staged(_repeated_ids(rows, classes))
    joined = staged(components(staged(links.unionByName(repeated))))
    rows_left = staged(_open_rows(tiles, classes, joined, num, den, tile_rows))
    found = joined
    if not rows_left.isEmpty():  # else the texts need not be read again
        late = _late_links(rows_left, _sets(rows_left, docs, classes, id_col, text_col, width), num, den)
        # What is joined already counts as one node.
        found = staged(components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(late)))
    placed = classes.select("key", "cls").join(found.withColumnRenamed("node", "cls"), "cls", "left").select(
        "key", F.coalesce("component", "cls").alias("component")
    )
    # Rows without words have no class; if their id has other rows, it has a component by them.
    by_id = repeated.select(F.col("b").alias("node")).distinct().join(found, "node").select("node", F.col("component").alias("own"))
    labelled = rows.join(placed, "key", "left").join(by_id, (F.col("n") == 0) & (F.col("doc").cast("long") == F.col("node")), "left")
    out = labelled.select(
        F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.coalesce("own", F.col("doc").cast("long"))).alias("component_id"),
    )
    return out.withColumn("component_id", F.when(F.col(id_col).isNotNull(), F.col("component_id")))
