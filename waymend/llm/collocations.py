"""Phrase collocation mining: set-oriented mining (SETM) over persisted occurrence relations.

Texts become pieces and words; an occurrence is (piece, position, word). The relation of
length 1 is written once, in blocks of some millions of words, sorted by piece and position.
For each length k the steps are those of SETM: (1) semi-join: occurrences of groups that are
not frequent leave the relation of length k - 1; (2) merge join: the sorted relation meets
itself at the next position of the same piece, which makes the occurrences of length k (two
overlapping groups of k - 1 words are one of k); (3) group-count: each block counts its
groups, Spark adds the blocks up; (4) the new relation is written and the loop goes on with
the frequent groups.

A block never splits a text, so the merge join needs no shuffle: it is one pass over
a sorted array. What is shuffled is one row for each distinct group of a block and the blocks
themselves, when the frequent groups are handed back to them. A phrase that a third of all
rows hold is one row per block. Groups are identified by the row of the smallest block that
holds them, so identity is exact (no hashes).

Score of a phrase of frequency a, cut into parts of frequencies l and r: floor(10**6 * a * a /
(l * r)), in decimal arithmetic. The lowest cut counts.

Defined cases: a null text is empty; a null language is ``und`` (one with rows of that name);
repeated rows count each; a text of any length is one part of a block; a table without frequent
phrases, or an empty one, gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymend.llm.common import staged

#: Stands for the end of a piece; no byte of UTF-8 text.
END = b"\xff"
#: A-Z in lower case, tab as space, [.,;:!?\x0A-\x0D] as the end of a piece.
BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + END * 10
)
#: Bytes of a text that are looked at together.
PART = 1 << 22
UNKNOWN_LANGUAGE = "und"
#: What ``extend`` gives: one row with the relation, the others with a group each.
EXTENDED = pa.schema([
    ("block", pa.int32()), ("relation", pa.binary()), ("place", pa.int32()), ("left", pa.int64()), ("right", pa.int64()), ("c", pa.int64())
])


def text_words(text: str | None) -> Iterator[list[bytes]]:
    """Words and ends of pieces of a text, in lists; long texts are cut between words."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(BYTES)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PART)
        end = len(raw) if end < 0 else end
        yield raw[at:end].replace(END, b" \xff ").split(b" ")
        at = end
    yield [END]


class Block:
    """Words of one language and block: a dictionary in order of arrival, and the occurrences."""

    def __init__(self):
        self.known: dict[bytes, int] = {END: -1, b"": -2}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        for w in set(words).difference(self.known):
            self.known[w] = len(self.known) - 2
        found = np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
        self.parts.append(found[found > -2])
        self.size += len(self.parts[-1])


def occurrences(docs: DataFrame, text_col: str, lang_col: str, block_words: int) -> DataFrame:
    """lang, words (the block's dictionary), counts, relation (int32: place in it, -1 after each piece)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[str, Block] = {}

        def written(lang: str) -> pa.RecordBatch:
            block = blocks.pop(lang)
            words, ids = list(block.known)[2:], np.concatenate(block.parts).astype("<i4")
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([[w.decode("utf-8", "replace") for w in words]], pa.list_(pa.string())),
                 pa.array([np.bincount(ids[ids >= 0], minlength=len(words))], pa.list_(pa.int64())), pa.array([ids.tobytes()], pa.binary())],
                names=["lang", "words", "counts", "relation"],
            )

        held = 0
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block = blocks.setdefault(lang, Block())
                held -= block.size
                for words in text_words(text):
                    block.add(words)
                held += block.size
                if held >= block_words:  # the largest one leaves
                    largest = max(blocks, key=lambda b: (blocks[b].size, b))
                    held -= blocks[largest].size
                    yield written(largest)
        for lang in sorted(blocks):
            yield written(lang)

    picked = docs.select(F.col(text_col).cast("string"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANGUAGE)))
    return picked.mapInArrow(run, "lang string, words array<string>, counts array<long>, relation binary")


def numbered(blocks: DataFrame) -> DataFrame:
    """The written blocks with a number each (an int)."""
    low = (1 << 33) - 1  # of the ids that Spark gives: partition above, row below
    blocks = staged(blocks.withColumn("id", F.monotonically_increasing_id()))
    rows = 1 + (blocks.agg(F.max(F.col("id").bitwiseAND(low))).first()[0] or 0)
    return blocks.withColumn("block", (F.shiftright("id", 33) * rows + F.col("id").bitwiseAND(low)).cast("int")).drop("id")


def word_groups(blocks: DataFrame) -> DataFrame:
    """block, place, lang, word, c: how often each word occurs in its block."""
    listed = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "x"))
    return listed.select("block", "place", "lang", F.col("x.words").alias("word"), F.col("x.counts").cast("long").alias("c"))


def frequent(groups: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Rows of groups that occur at least ``least`` times in all blocks, with their total ``f`` and
    ``id``: block and place of the first row of the group."""
    group = Window.partitionBy(*keys)
    row = F.shiftleft(F.col("block").cast("long"), 32).bitwiseOR(F.col("place").cast("long"))
    return groups.withColumn("f", F.sum("c").over(group)).withColumn("id", F.min(row).over(group)).where(F.col("f") >= least)


def extend(key, relation: pa.Table, known: pa.Table) -> pa.Table:
    """Semi-join with the frequent groups and merge join with the next position, of one block.

    Gives the relation of the next length, and one row for each distinct group in it.
    """
    if not relation.num_rows or not known.num_rows:
        return EXTENDED.empty_table()
    block = key[0].as_py()
    ids = np.frombuffer(relation["relation"][0].as_py(), "<i4")
    place = known["place"].to_numpy().astype(np.int64)
    order = np.argsort(place)
    place, names = place[order], known["id"].to_numpy()[order]
    # Semi-join: rank among the frequent groups, -1 for the others and the ends of pieces.
    rank = np.full(max(int(ids.max()), int(place[-1])) + 2, -1, np.int64)
    rank[place] = np.arange(len(place))
    now = rank[ids]  # -1 finds the last entry, which is -1
    # Merge join: both relations are sorted by position, so the partner is the next entry.
    both = np.flatnonzero((now[:-1] >= 0) & (now[1:] >= 0))
    pairs = now[both] * len(place) + now[both + 1]
    distinct, back, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    longer = np.full(len(ids), -1, "<i4")
    longer[both] = back
    n = len(distinct)
    head = pa.Table.from_pydict(
        {"block": [block], "relation": [longer.tobytes()], "place": [None], "left": [None], "right": [None], "c": [None]}, EXTENDED
    )
    rows = pa.Table.from_arrays(
        [pa.array(np.full(n, block, np.int32)), pa.nulls(n, pa.binary()), pa.array(np.arange(n, dtype=np.int32)),
         pa.array(names[distinct // len(place)]), pa.array(names[distinct % len(place)]), pa.array(counts.astype(np.int64))],
        schema=EXTENDED,
    )
    return pa.concat_tables([head, rows])


def scored(a, l, r):
    """floor(10**6 * a * a / (l * r)), exact beyond 64 bits."""
    whole = "decimal(20,0)"
    above = (F.lit(1_000_000).cast("decimal(7,0)") * (a.cast(whole) * a.cast(whole)).cast("decimal(31,0)")).cast("decimal(38,0)")
    below = (l.cast(whole) * r.cast(whole)).cast("decimal(38,0)")
    return F.call_function("div", above, below).cast("long")


def mine(docs: DataFrame, text_col="text", lang_col="lang", longest: int = 3, least: int = 10, block_words: int = 4_000_000) -> tuple[DataFrame, DataFrame]:
    """(phrases, sizes): lang, phrase, words, a, l, r, score, nested of every frequent phrase of 2
    to ``longest`` words, and n (word occurrences) of every language.

    ``nested``: the largest frequency of a frequent phrase that holds this one (null: none).
    """
    blocks = numbered(occurrences(docs, text_col, lang_col, block_words))
    counted = staged(word_groups(blocks))
    sizes = counted.groupBy("lang").agg(F.sum("c").alias("n"))
    level = staged(frequent(counted, ["lang", "word"], least).select("block", "place", "id", "f", "lang", "word"))
    first = F.col("id") == F.shiftleft(F.col("block").cast("long"), 32).bitwiseOR(F.col("place").cast("long"))
    names = level.where(first).select("id", "lang", F.col("word").alias("phrase"), "f")
    words, relation, found = names, blocks.select("block", "relation"), []
    for length in range(2, longest + 1):
        made = relation.groupBy("block").cogroup(level.select("block", "place", "id").groupBy("block")).applyInArrow(
            extend, "block int, relation binary, place int, left long, right long, c long"
        )
        made = staged(made)
        relation = made.where("relation is not null").select("block", "relation")
        groups = made.where("relation is null").select("block", "place", "left", "right", "c")
        level = staged(frequent(groups, ["left", "right"], least))
        heads, shorter = level.where(first).select("id", "left", "right", "f"), names
        # Left part and right part overlap in all but their first and last word.
        joined = (
            heads.join(shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("start"), F.col("f").alias("left_f"),
                                      *([F.col("starts")] if length > 2 else [])), "left")
            .join(shorter.select(F.col("id").alias("right"), F.col("phrase").alias("rest"), F.col("f").alias("right_f"),
                                 *([F.col("ends")] if length > 2 else [])), "right")
        )
        last = F.element_at(F.split("rest", " "), -1)
        # Frequencies of the first 1 .. k - 1 words and of the last 1 .. k - 1 words.
        starts = F.array("left_f") if length == 2 else F.concat("starts", F.array("left_f"))
        ends = F.array("right_f") if length == 2 else F.concat("ends", F.array("right_f"))
        names = staged(joined.select(
            "id", "left", "right", "lang", F.concat_ws(" ", "start", last).alias("phrase"), "f",
            starts.alias("starts"), ends.alias("ends"),
        ))
        cuts = F.transform(
            F.sequence(F.lit(1), F.lit(length - 1)),
            lambda k: F.struct(
                scored(F.col("f"), F.element_at("starts", k), F.element_at("ends", F.lit(length) - k)).alias("score"), k.alias("k"),
                F.element_at("starts", k).alias("l"), F.element_at("ends", F.lit(length) - k).alias("r"),
            ),
        )
        cut = F.array_min(cuts)
        found.append(names.select("id", "lang", "phrase", F.lit(length).alias("words"), F.col("f").alias("a"), cut.alias("cut"), "left", "right"))
    parts = []
    for shorter, longer in zip(found, [*found[1:], None], strict=True):
        if longer is None:
            parts.append(shorter.withColumn("nested", F.lit(None).cast("long")))
            continue
        # A phrase of two more words holds one of one more that is at least as frequent.
        held = longer.select(F.explode(F.array("left", "right")).alias("id"), "a").groupBy("id").agg(F.max("a").alias("nested"))
        parts.append(shorter.join(held, "id", "left"))
    columns = ["lang", "phrase", "words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"), "nested"]
    phrases = parts[0].select(*columns)
    for part in parts[1:]:
        phrases = phrases.unionByName(part.select(*columns))
    return phrases, sizes


def collocations(
    docs: DataFrame, text_col="text", lang_col="lang", longest: int = 3, least: int = 10, nested_share: tuple[int, int] = (50, 100),
    top: int = 2000, block_words: int = 4_000_000,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    A phrase goes when a longer frequent one holds it and has ``nested_share`` of its frequency.
    """
    phrases, sizes = mine(docs, text_col, lang_col, longest, least, block_words)
    num, den = nested_share
    alone = phrases.where(F.col("nested").isNull() | (den * F.col("nested") < num * F.col("a")))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = alone.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
