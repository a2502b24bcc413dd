"""What the corpus operators share: table access, the shared folder, free column names, flat hashing of words."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: dict[str, str] = {}


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if _shipped.get("to") == sc.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    at = f"{tempfile.mkdtemp(prefix='aerolith-')}/{root.name}.zip"
    with zipfile.ZipFile(at, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(at)
    _shipped["to"] = sc.applicationId


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a folder of our own, but only if driver and executors are one process (tests)."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="aerolith-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at


def work_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that a lost executor does not undo it."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once and kept in the shared folder as Parquet: for wide rows, which take less room so."""
    at = work_dir(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def one_each(kept: DataFrame, group: str, repeated: str, columns: list[str]) -> DataFrame:
    """One row, of the given columns, of each group of kept. Only groups marked as repeated are grouped: of their rows the one with the least hash of its columns stays, chosen before the shuffle."""
    row = F.struct(*columns)
    picked = kept.filter(F.col(repeated)).groupBy(group).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("row"))
    return kept.filter(~F.col(repeated)).select(*columns).unionAll(picked.select("row.*"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df does not have, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        free, k = f"_{name}", 0
        while free.lower() in taken:
            k += 1
            free = f"_{name}{k}"
        taken.add(free.lower())
        out.append(free)
    return out


def text_of(name: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


# --- words and shingles of a whole batch in flat arrays ---------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Rows that are hashed at a time: what they need is some tens of MB.
HASH_ROWS = 500
#: The white space that parts words: space and 9 to 13.
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """The first n powers of the base; the table grows to the longest word met."""
    global _powers
    if len(_powers) < n:
        _powers = np.full(1 << (n - 1).bit_length(), _BASE, np.uint64)
        _powers[0] = 1
        _powers = np.multiply.accumulate(_powers)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values with well spread bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each begins (one more entry than texts). Nulls are empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2] if len(texts) else None
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return flat, offsets - offsets[0]


def word_hashes(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of each text, and where each text's words begin. A word is a run of bytes that are not white space; a text's end also ends a word."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    inside = ~_SPACE[flat]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[starts] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()  # the last byte of a word
    closes[:-1] &= ~inside[1:] | edge[1:n]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    sizes = end - begin
    first = np.cumsum(sizes) - sizes  # of each word among the bytes inside words
    place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
    words = np.add.reduceat((flat[inside].astype(np.uint64) + np.uint64(1)) * _power(int(sizes.max()))[place], first)
    return mix(words), np.searchsorted(begin, starts)


def shingle_hashes(words: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of each text, and where each text's begin. A text with 1 to n - 1 words has one shingle of all its words, an empty one none."""
    counts = np.diff(starts)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    steps = np.array([pow(int(_BASE), n - 1 - k, 1 << 64) for k in range(n)], np.uint64)
    have = np.maximum(counts - n + 1, np.minimum(counts, 1))
    out_starts = np.zeros(len(starts), np.int64)
    np.cumsum(have, out=out_starts[1:])
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    rolled = np.zeros(len(words), np.uint64)
    for k in range(n):
        rolled += padded[k : k + len(words)] * steps[k]
    where = np.repeat(starts[:-1] - out_starts[:-1], have) + np.arange(out_starts[-1])
    out = rolled[where]
    short = np.flatnonzero((counts > 0) & (counts < n))
    for i in short:
        out[out_starts[i]] = np.uint64(sum(int(w) * pow(int(_BASE), k, 1 << 64) for k, w in enumerate(words[starts[i] : starts[i + 1]])) + int(counts[i]) & (1 << 64) - 1)
    return mix(out), out_starts
