"""Small parts that several operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every "words" contract: [\x20\x09-\x0D], which is what bytes.split() cuts at.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

GAP = re.compile(rb"[\x20\x09-\x0d]")

FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64
)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared folder once and go on from the written table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores behind it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold_remainder(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the split into learned and held-out rows."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def word_pieces(text: str | None, lower: bool = False, piece: int = 1 << 20):
    """Lists of words (bytes) of a text, cut between words every ``piece`` bytes or so."""
    for part in _cut((text or "").encode("utf-8", "surrogatepass"), piece):
        yield (part.lower() if lower else part).split()


def _cut(raw: bytes, piece: int):
    at = 0
    while at < len(raw):
        found = GAP.search(raw, at + piece)
        end = found.start() if found else len(raw)
        yield raw[at:end]
        at = end


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


#: A random value for each byte (0 for white space) and the powers of a random odd number.
_RANDOM = np.random.default_rng(20240229)
BYTE_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUES[[32, *range(9, 14)]] = 0
IS_GAP = BYTE_VALUES == 0
LONG_WORD = 512
POWERS = np.cumprod(np.full(LONG_WORD, FACTORS[1]))


def _hashes(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    gaps = np.flatnonzero(IS_GAP[b])
    starts = np.concatenate([[0], gaps + 1])
    sizes = np.diff(np.append(starts, len(b) + 1)) - 1
    if starts[-1] == len(b):
        starts, sizes = starts[:-1], sizes[:-1]
    if not len(starts):
        return np.empty(0, np.uint64)
    place = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    np.minimum(place, LONG_WORD - 1, out=place)
    sums = np.add.reduceat(BYTE_VALUES[b] * POWERS[place], starts)
    out = mixed(sums + sizes.astype(np.uint64) * FACTORS[2])
    for i in np.flatnonzero(sizes >= LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(raw[starts[i] : starts[i] + sizes[i]])
    return out[sizes > 0]


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hashes of a text's words in order; A-Z in lower case if asked. Long texts in pieces."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    parts = [_hashes(part.lower() if lower else part) for part in _cut(raw, 1 << 17)]
    return parts[0] if len(parts) == 1 else np.concatenate([np.empty(0, np.uint64), *parts])


def window_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """One 64-bit hash for every run of ``width`` consecutive word hashes."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    factor = FACTORS[seed]
    total = words[:count].copy()
    for i in range(1, width):
        total *= factor
        total += words[i : i + count]
    return mixed(total ^ factor)
