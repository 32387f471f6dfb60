"""Spelling variants: words one edit apart, found by k-d trees over letter-count vectors.

A word is a vector of how often each letter stands in it. Replacing a letter takes one from a
count and adds one to another (L1 distance two), inserting one adds one to a single count (L1
distance one). So the words near a word lie within such a step of its vector: in the tree of
its own length (one up, one down) and in the tree of the next length (one up); words that are
one letter shorter find it the same way. A branch whose box needs more steps is pruned, a leaf
is compared by the parity of its counts, then by the counts, and what is left by the order of
the letters, which decides.

The upper part of each tree is fitted on a bounded sample of words and gives the cells by which
Spark deals the work; every word is a point of one cell and a query in each cell that its
box reaches. Inside a cell a tree over all of its points goes on to leaves of ``LEAF`` words. The
sample decides the balance, never the result. A cell of too many points (many words of the
same letters, say) is cut by a hash of the word, and its queries go to every part.

Every cell hands on one row for each word that found something: how many words, and the best of
them, so no group of near words is ever listed in one place.

Defined cases: a null text has no words; a null id is an empty text in front of the colon;
repeated rows count each; runs of letters of any length are one word; a table without words
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.llm.common import shuffle_partitions, staged

#: Latin-1 bytes: runs of [A-Za-zÀ-ÿ] with A-Z in lower case, all else as spaces.
RUNS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256))
#: Place of each letter in a vector.
PLACES = np.zeros(256, np.int64)
PLACES[97:123], PLACES[192:256] = np.arange(26), np.arange(26, 90)
LETTERS = 90
LEAF, PART, REMEMBERED, MOST_PAIRS = 64, 1 << 22, 400_000, 1 << 20


def text_runs(text: str | None) -> Iterator[list[bytes]]:
    """Runs of letters in lower case, as Latin-1 bytes; long texts in parts cut between runs."""
    raw = (text or "").encode("latin-1", "replace").translate(RUNS)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PART)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def changed(run: bytes, before: int, modulus: int) -> bytes:
    """The run, without one of its letters if the crc32 of id, colon and run says so.

    ``before``: crc32 of the id and the colon.
    """
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id_col="doc_id", text_col="text", shortest=6, least=5, modulus=199) -> DataFrame:
    """word, n: distinct words of at least ``shortest`` letters that occur ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()

        def emptied() -> pa.RecordBatch:
            words, n = [w.decode("latin-1") for w in totals], list(totals.values())
            totals.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                before = zlib.crc32(f"{doc or ''}:".encode("utf-8", "surrogatepass"))
                for runs in text_runs(text):
                    for found, n in Counter(runs).items():
                        if len(found) >= shortest:
                            word = changed(found, before, modulus)
                            if len(word) >= shortest:
                                totals[word] += n
                    if len(totals) > REMEMBERED:
                        yield emptied()
        yield emptied()

    counted = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def vectors(words: list[bytes]) -> np.ndarray:
    """words x letters; counts beyond 255 stay at 255, which never makes two words look farther apart."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = PLACES[np.frombuffer(b"".join(words), np.uint8)]
    out = np.empty((len(words), LETTERS), np.uint8)
    ends = np.cumsum(sizes)
    for a in range(0, len(words), 20_000):
        b = min(a + 20_000, len(words))
        first, last = ends[a] - sizes[a], ends[b - 1]
        place = np.repeat(np.arange(b - a), sizes[a:b]) * LETTERS + letters[first:last]
        out[a:b] = np.minimum(np.bincount(place, minlength=(b - a) * LETTERS), 255).reshape(b - a, LETTERS)
    return out


def split_of(points: np.ndarray) -> tuple[int, int] | None:
    """(letter, t): counts up to t go left. The letter that varies most; None if all points are the same."""
    spread = points.astype(np.float32).var(0)
    for letter in np.argsort(-spread, kind="stable"):
        column = points[:, letter]
        low, high = int(column.min()), int(column.max())
        if low == high:
            return None
        cuts = np.arange(low, high)
        left = np.searchsorted(np.sort(column), cuts, side="right")
        return int(letter), int(cuts[np.argmin(np.abs(2 * left - len(column)))])
    return None


class Tree:
    """A k-d tree over count vectors: ``nodes`` are (letter, t, left, right) or (-1, leaf, 0, 0)."""

    def __init__(self, points: np.ndarray, most: float, deepest: int = 60):
        self.nodes: list[tuple[int, int, int, int]] = []
        self.leaves: list[np.ndarray] = []
        self._grow(points, np.arange(len(points)), most, deepest)

    def _grow(self, points, rows, most, depth) -> int:
        place = len(self.nodes)
        self.nodes.append((-1, len(self.leaves), 0, 0))
        split = split_of(points[rows]) if len(rows) > most and depth else None
        if split is None:
            self.leaves.append(rows)
            return place
        letter, t = split
        left = points[rows, letter] <= t
        a = self._grow(points, rows[left], most, depth - 1)
        b = self._grow(points, rows[~left], most, depth - 1)
        self.nodes[place] = (letter, t, a, b)
        return place


def leaf_of(nodes: list[tuple[int, int, int, int]], points: np.ndarray) -> np.ndarray:
    """The leaf that each point belongs to."""
    out, stack = np.zeros(len(points), np.int64), [(0, np.arange(len(points)))]
    while stack:
        node, rows = stack.pop()
        letter, t, a, b = nodes[node]
        if letter < 0:
            out[rows] = t
        elif len(rows):
            left = points[rows, letter] <= t
            stack += [(a, rows[left]), (b, rows[~left])]
    return out


def reached(nodes: list[tuple[int, int, int, int]], queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, queries): those whose counts can come into the leaf's box with ``up`` letters added and
    ``down`` taken away."""
    n = len(queries)
    bounds: dict[int, tuple[int, int]] = {}
    stack = [(0, np.arange(n), np.zeros(n, np.int16), np.zeros(n, np.int16), bounds)]
    while stack:
        node, rows, added, taken, bounds = stack.pop()
        if not len(rows):
            continue
        letter, t, a, b = nodes[node]
        if letter < 0:
            yield t, rows
            continue
        low, high = bounds.get(letter, (0, 255))
        c = queries[rows, letter].astype(np.int16)
        less = taken + np.maximum(c - t, 0) - np.maximum(c - high, 0)
        more = added + np.maximum(t + 1 - c, 0) - np.maximum(low - c, 0)
        go = less <= down
        stack.append((a, rows[go], added[go], less[go], {**bounds, letter: (low, t)}))
        go = more <= up
        stack.append((b, rows[go], more[go], taken[go], {**bounds, letter: (t + 1, high)}))


def parities(points: np.ndarray) -> np.ndarray:
    """64 bits of each vector: parity of the counts (letters folded). One step changes at most one bit."""
    odd = np.zeros((len(points), 64), np.uint8)
    odd ^= points[:, :64] & 1
    odd[:, : LETTERS - 64] ^= points[:, 64:] & 1
    return np.packbits(odd, axis=1).view(np.uint64).ravel()


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a (rows of letters) become b, of the same length or one longer, by one edit."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(1) == 1
    front = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return front + back >= n


def near_pairs(points: list[bytes], queries: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) indices of words one edit apart. All points are of one length, all queries
    of the same or of one less."""
    if not points or not queries:
        return
    longer = len(points[0]) - len(queries[0])
    steps = 1 if longer else 2
    p, q = vectors(points), vectors(queries)
    tree = Tree(p, LEAF)
    p_bits, q_bits = parities(p), parities(q)
    p_letters = np.frombuffer(b"".join(points), np.uint8).reshape(len(points), -1)
    q_letters = np.frombuffer(b"".join(queries), np.uint8).reshape(len(queries), -1)
    exact = len(points[0]) < 256  # then no count is cut, and the L1 distance is exactly ``steps``
    for leaf, rows in reached(tree.nodes, q, 1, 1 - longer):
        members = tree.leaves[leaf]
        step = max(1, MOST_PAIRS // max(len(members), 1))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            close = np.bitwise_count(q_bits[some][:, None] ^ p_bits[members][None]) <= steps
            i, j = np.nonzero(close)
            i, j = some[i], members[j]
            for cut in range(0, len(i), 50_000):
                a, b = i[cut : cut + 50_000], j[cut : cut + 50_000]
                far = np.abs(q[a].astype(np.int16) - p[b]).sum(1)
                keep = far == steps if exact else far <= steps
                a, b = a[keep], b[keep]
                width = max(1, (1 << 24) // max(1, p_letters.shape[1]))
                for k in range(0, len(a), width):
                    x, y = a[k : k + width], b[k : k + width]
                    right = one_edit(q_letters[x], p_letters[y])
                    if right.any():
                        yield x[right], y[right]


def upper_trees(words: DataFrame, sample_words: int, cell_words: int, seed: int = 23) -> dict[int, list[tuple[int, int, int, int]]]:
    """The nodes of the upper tree of each length that needs one, from a bounded sample of words."""
    total = words.count()
    picked = words.select("word").orderBy(F.xxhash64("word", F.lit(seed)), "word").limit(sample_words).collect() if total > cell_words else []
    by_length: dict[int, list[bytes]] = {}
    for r in picked:
        by_length.setdefault(len(r["word"]), []).append(r["word"].encode("latin-1"))
    most = max(16.0, cell_words * len(picked) / max(total, 1))
    trees = {length: Tree(vectors(sorted(some)), most).nodes for length, some in by_length.items() if len(some) > most}
    return {length: nodes for length, nodes in trees.items() if len(nodes) > 1}


def dealt(words: DataFrame, trees: dict[int, list[tuple[int, int, int, int]]], asking: bool = True) -> DataFrame:
    """length, leaf, point, word, n: each word as a point of its cell and, if ``asking``, as a query in
    every cell that its steps reach."""
    shared = words.sparkSession.sparkContext.broadcast(trees)  # at most the sample's size
    single = [(-1, 0, 0, 0)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for batch in batches:
            text, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            sizes = np.fromiter(map(len, text), np.int64, len(text))
            for length in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == length)
                v = vectors([w.encode("latin-1") for w in text[rows]])
                own = trees.get(length, single)
                parts = [(length, leaf_of(own, v), True, np.arange(len(rows)))]
                for tree_length, up, down in ((length, 1, 1), (length + 1, 1, 0)) if asking else ():
                    for leaf, some in reached(trees.get(tree_length, single), v, up, down):
                        parts.append((tree_length, np.full(len(some), leaf), False, some))
                for tree_length, leaf, point, some in parts:
                    k = len(some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, tree_length, np.int32)), pa.array(leaf.astype(np.int32)), pa.array([point] * k, pa.bool_()),
                         pa.array(text[rows[some]].tolist(), pa.string()), pa.array(n[rows[some]], pa.int64())],
                        names=["length", "leaf", "point", "word", "n"],
                    )

    return words.select("word", "n").mapInArrow(run, "length int, leaf int, point boolean, word string, n long")


BEST = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def cell_bests(cell: pa.Table) -> pa.Table:
    """For each word of a cell that has near words in it: how many, and the most frequent of them."""
    point = cell["point"].to_numpy(zero_copy_only=False).astype(bool)
    text, n = [w.encode("latin-1") for w in cell["word"].to_pylist()], cell["n"].to_numpy()
    at = np.flatnonzero(point)
    points = [text[i] for i in at]
    length = int(cell["length"][0].as_py())
    sizes = np.fromiter(map(len, text), np.int64, len(text))
    found: dict[bytes, list] = {}

    def add(word: bytes, other: bytes, other_n: int) -> None:
        seen = found.get(word)
        if seen is None:
            found[word] = [1, other_n, other]
        else:
            seen[0] += 1
            # Latin-1 bytes sort like code points.
            if other_n > seen[1] or (other_n == seen[1] and other < seen[2]):
                seen[1], seen[2] = other_n, other

    for size in (length, length - 1):
        asking = np.flatnonzero(~point & (sizes == size))
        for q, p in near_pairs(points, [text[i] for i in asking]):
            for i, j in zip(asking[q].tolist(), at[p].tolist(), strict=True):
                add(text[i], text[j], int(n[j]))
                if size < length:
                    add(text[j], text[i], int(n[i]))
    return pa.Table.from_arrays(
        [pa.array([w.decode("latin-1") for w in found], pa.string()), pa.array([x[0] for x in found.values()], pa.int64()),
         pa.array([x[1] for x in found.values()], pa.int64()), pa.array([x[2].decode("latin-1") for x in found.values()], pa.string())],
        schema=BEST,
    )


def nearest(words: DataFrame, sample_words: int = 100_000, cell_words: int = 20_000) -> DataFrame:
    """word, n_near, best, best_n for every word that has near words among ``words`` (word, n)."""
    trees = upper_trees(words, sample_words, cell_words)
    rows = dealt(words, trees)
    # Cells that hold more points than planned are cut; their queries go to every part.
    sizes = dealt(words, trees, asking=False).groupBy("length", "leaf").agg(F.ceil(F.count(F.lit(1)) / (4 * cell_words)).cast("int").alias("parts"))
    parts = F.when(F.col("point"), F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("parts") - 1)
    )
    cells = rows.join(sizes, ["length", "leaf"]).withColumn("part", F.explode(parts))
    # Cells are small in bytes and long in work: a number of tasks that follows the cells, not the bytes.
    leaves = sum(node[0] < 0 for nodes in trees.values() for node in nodes)
    cells = cells.repartition(max(shuffle_partitions(words.sparkSession), 2 * leaves), "length", "leaf", "part")
    bests = cells.groupBy("length", "leaf", "part").applyInArrow(cell_bests, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return bests.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("x")).select(
        "word", "n_near", F.col("x.best").alias("best"), (-F.col("x.less")).alias("best_n")
    )


def roots(links: DataFrame) -> DataFrame:
    """word, root: the end of the chain word -> form -> form of that ... (links have no cycles).

    Every round doubles the length of the steps.
    """
    now = staged(links.select("word", F.col("form").alias("root")))
    while True:
        steps = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = staged(now.join(steps, "root", "left").select("word", "root", "further"))
        if longer.where("further is not null").isEmpty():
            return now
        now = longer.select("word", F.coalesce("further", "root").alias("root"))


def variants(
    docs: DataFrame, id_col="doc_id", text_col="text", shortest: int = 6, least: int = 5, modulus: int = 199, times: int = 5,
    sample_words: int = 100_000, cell_words: int = 20_000,
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word.

    A word's form is its most frequent near word, if that occurs ``times`` as often.
    """
    words = staged(word_counts(docs, id_col, text_col, shortest, least, modulus))
    joined = words.join(nearest(words, sample_words, cell_words), "word", "left")
    is_form = F.col("best_n") >= times * F.col("n")
    formed = staged(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    ))
    ends = roots(formed.where("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
