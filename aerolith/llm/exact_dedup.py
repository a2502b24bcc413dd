"""Exact dedup against a registry of digests seen before.

The registry holds each distinct digest of the history once. It is cut into shards by the digest's first bytes; a shard
is one row with a minimal perfect hash over its digests (levels of collision-free bits), whose slots hold the full digest,
the locator of the row that stays (its largest doc_id) and the number of rows. A digest that arrives finds its slot without any search; its bytes
are compared with the slot's, so that a stranger that falls on a slot is not taken for a member. Members update their
slot; nonmembers form groups of their own.

Scale: rows are reduced to (doc_id, 32-byte digest) before anything is shuffled, and to one row per digest by map-side
aggregation before they are dealt by digest, so that a text with a third of all rows is one row per task. The number of
shards grows with the rows of history and arrivals, so that a task holds some tens of thousands of digests. The join back is a plain equi-join with rows
on its left side, whose hot keys adaptive execution splits.

Defined cases: a null text is empty. A null doc_id never stays unless all of its group are null. Rows that repeat both text
and doc_id cannot be told apart: they share one keep_id and all count as kept; drop_copies leaves one of them. Ties do not arise otherwise. Empty
tables give empty results. Other columns, whatever their names, are neither read nor disturbed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, mix, one_each, ship, table, text_of

#: About so many digests in a shard: 0.8 MB of slots.
SHARD_DIGESTS = 1 << 14
#: Bits of a level of the hash for each digest that it has to place.
GAMMA = 2.0
_INDEX = "shard long, n long, levels binary, bits binary, digests binary, winners binary, has binary, counts binary"
_GROUPS = "digest binary, keep_id long, group_size long, historical boolean"


class PerfectHash:
    """A minimal perfect hash over distinct 32-byte digests: level after level, a digest alone on its position sets the bit there; the others go to the next level. A digest's slot is the number of bits before its own."""

    def __init__(self, levels: np.ndarray, bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.starts = np.concatenate([[0], np.cumsum(levels)])
        self.rank = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @staticmethod
    def _at(words: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        h = np.zeros(len(words), np.uint64)
        for k in range(4):
            h = mix(h ^ words[:, k] + salt)
        return (h % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, digests: np.ndarray) -> PerfectHash:
        words, levels, bits = digests.view("<u8").reshape(-1, 4), [], []
        while len(words):
            size = max(64, int(len(words) * GAMMA))
            at = cls._at(words, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(size)
            bits.append(alone)
            words = words[~alone[at]]
        return cls(np.array(levels, np.int64), np.concatenate(bits) if bits else np.zeros(0, bool))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 if none can be its own."""
        words, out = digests.view("<u8").reshape(-1, 4), np.full(len(digests), -1, np.int64)
        left = np.arange(len(words))
        for level, size in enumerate(self.levels):
            if not len(left):
                break
            at = self._at(words[left], level, int(size)) + self.starts[level]
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left = left[~hit]
        return out


def _matrix(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(-1, 32).copy()


def _longs(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _flags(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False).astype(bool)


def _build(rows: pa.Table) -> pa.Table:
    """One row: the shard's index. Winners are whole numbers beside a mark of whether there is one, never floats."""
    digests = _matrix(rows["digest"])
    index = PerfectHash.build(digests)
    order = np.empty(len(digests), np.int64)
    order[index.slots(digests)] = np.arange(len(digests))
    values = [rows["shard"][0].as_py(), len(digests), index.levels.tobytes(), np.packbits(index.bits).tobytes(), digests[order].tobytes(), *[x[order].tobytes() for x in (_longs(rows["winner"]), _flags(rows["known"]), _longs(rows["n"]))]]
    names = ["shard", "n", "levels", "bits", "digests", "winners", "has", "counts"]
    return pa.Table.from_arrays([pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for v in values], names)


def _look_up(new: pa.Table, held: pa.Table) -> pa.Table:
    """All groups of a shard: the registry's slots, updated by the members among new, then the nonmembers."""
    winner, known, n = _longs(new["winner"]), _flags(new["known"]), _longs(new["n"])
    digests = _matrix(new["digest"])
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]] = []
    stranger = np.ones(len(digests), bool)
    for row in held.to_pylist():  # one
        levels = np.frombuffer(row["levels"], np.int64)
        index = PerfectHash(levels, np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=int(levels.sum())).astype(bool))
        slots_of = np.frombuffer(row["digests"], np.uint8).reshape(-1, 32)
        stays, has, counts = np.frombuffer(row["winners"], np.int64).copy(), np.frombuffer(row["has"], bool).copy(), np.frombuffer(row["counts"], np.int64).copy()
        slot = index.slots(digests)
        member = slot >= 0
        member[member] = (slots_of[slot[member]] == digests[member]).all(axis=1)
        stranger &= ~member
        counts[slot[member]] += n[member]  # digests are distinct, so slots are
        better = member & known
        better[better] = ~has[slot[better]] | (winner[better] > stays[slot[better]])
        stays[slot[better]], has[slot[better]] = winner[better], True
        found.append((slots_of, stays, has, counts, True))
    found.append((digests[stranger], winner[stranger], known[stranger], n[stranger], False))
    slots, keep, has, counts = (np.concatenate([f[k] for f in found]) for k in range(4))
    old = np.concatenate([np.full(len(f[0]), f[4]) for f in found])
    return pa.Table.from_arrays([pa.array([x.tobytes() for x in slots], pa.binary()), pa.array(keep, pa.int64(), mask=~has), pa.array(counts, pa.int64()), pa.array(old)], ["digest", "keep_id", "group_size", "historical"])


def _with_shard(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("shard", F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(shards)))


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, digest) of every row: SHA-256 of the whole text in UTF-8."""
    ship(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.sha2(text_of(text), 256)).alias("digest"))


def distinct_digests(rows: DataFrame) -> DataFrame:
    """(digest, winner, known, n): known tells whether there is a winner."""
    grouped = rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))
    return grouped.select("digest", F.coalesce("winner", F.lit(0)).alias("winner"), F.col("winner").isNotNull().alias("known"), "n")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the registry, from rows of digests()."""
    return _with_shard(distinct_digests(history), shards).groupBy("shard").applyInArrow(_build, _INDEX)


def groups(arriving: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """(digest, keep_id, group_size, historical) of all digests, those of the index and those of rows of digests() that arrive."""
    new = _with_shard(distinct_digests(arriving), shards)
    return new.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_look_up, _GROUPS)


def _resolve(rows: DataFrame, history: DataFrame, arriving: DataFrame) -> DataFrame:
    shards = max(1, -(-(history.count() + arriving.count()) // SHARD_DIGESTS))
    return groups(arriving, build_index(history, shards), shards)


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each row's group: doc_id, keep_id, group_size, kept, text_sha256, historical.

    The table comes as two deliveries, parted by a hash of doc_id: the first fills the registry, the second is looked up
    in it. The result does not depend on the parting.
    """
    rows = cut(digests(docs, text, doc_id))
    first = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    found = _resolve(rows, rows.filter(first), rows.filter(~first))
    joined = rows.join(found, "digest", "left")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "historical")


def drop_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without the rows that are copies of one that stays; same columns. Of rows that repeat the doc_id that stays as well, or that all have none, one stays."""
    rows = cut(digests(docs, text, doc_id))
    first = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    found = _resolve(rows, rows.filter(first), rows.filter(~first))
    again = cut(rows.groupBy("digest", "doc_id").count().filter("count > 1").select(F.col("digest").alias("of"), "doc_id"))
    key, keep, repeated = fresh(docs, "digest", "keep", "repeated")
    some = not again.isEmpty()
    if some:
        found = found.join(again, (F.col("digest") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("keep_id")), "left")
    found = found.select(F.col("digest").alias(key), F.col("keep_id").alias(keep), (F.col("of").isNotNull() if some else F.lit(False)).alias(repeated))
    own, *_ = fresh(docs.withColumns({x: F.lit(0) for x in (key, keep, repeated)}), "own")
    marked = docs.withColumn(own, F.unhex(F.sha2(text_of(text), 256)))
    # by digest and id together, so that a text with a third of all rows is no hot key
    kept = marked.join(found, (F.col(own) == F.col(key)) & F.col(doc_id).cast("long").eqNullSafe(F.col(keep)))
    return one_each(kept, key, repeated, docs.columns) if some else kept.select(*docs.columns)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("historical")


OP9_SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""
