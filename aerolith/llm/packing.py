"""Best-fit packing of documents into bins of a fixed number of tokens, under conflicts.

A document longer than a bin is cut into full pieces, each a bin of its own, and a tail; tails and whole documents are placed
by decreasing size. Open bins are ordered by what is left in them. Bitmaps, kept by source and by duplicate cluster, tell which bins hold it. The
search begins at the tightest bins that have room, all bins with as much left at once, and goes on to their successors until some hold neither the document's
source nor its cluster: the first of them is the tightest compatible bin. If there is none, a bin is opened.

Scale: documents are dealt by a hash into shards of about SHARD_DOCS, whatever their source, so that a hot source or cluster is
spread evenly. Rows that agree in all that is packed are counted first, and their copies are spread evenly over the shards, beginning with the one of their hash. Shards are packed apart, each by one task that holds (id, size, source, cluster) of its documents only. Their
number grows with the documents. Bins are named by shard and place; the packing is the same on every run. As bins do not span shards, the last bins of each stay part empty, a price of about one bin in two hundred (README).

Defined cases: a null or empty text has no tokens and is placed as a piece of size 0 that keeps the conflicts, in a bin of its own only where no compatible one exists. A null source is a source of its own; a null
cluster is in conflict with nothing. Documents of equal size go by doc_id, nulls first, then by source and cluster. Repeated rows are placed each. Very long
texts give as many pieces as they need. Other columns are ignored. An empty table gives no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, ship, table, text_of

CAPACITY = 2048
SHARD_DOCS = 4096
_PIECES = "doc_id long, piece long, start_token long, n_tokens long, bin_id long, bin_offset long"


def pack(items: list[tuple], capacity: int) -> list[tuple]:
    """Places (doc_id, size, source, cluster); returns (doc_id, piece, start, size, bin, offset) of every piece."""
    often = {c for c, n in Counter(i[3] for i in items if i[3] is not None).items() if n > 1}
    out: list[tuple] = []
    bins = 0
    rest: list[tuple] = []
    order = sorted(items, key=lambda i: (i[0] is not None, i[0] or 0, i[2] is not None, i[2] or "", i[3] is not None, i[3] or 0))
    for doc_id, size, source, cluster in order:
        full = (size - 1) // capacity if size else 0
        for k in range(full):
            out.append((doc_id, k, k * capacity, capacity, bins, 0))
            bins += 1
        rest.append((doc_id, full, full * capacity, size - full * capacity, source, cluster))
    rest.sort(key=lambda r: -r[3])
    left: list[int] = []  # amounts that some open bin has left, in order
    holding: dict[int, int] = {}  # the open bins with that much left, as a bitmap
    with_source: dict[int, int] = {}  # the open bins that hold a source, and a cluster
    with_cluster: dict[int, int] = {}
    number: list[int] = []  # of each open bin
    for doc_id, piece, start, size, source, cluster in rest:
        taken = with_source.get(source, 0) | with_cluster.get(cluster, 0)
        k = bisect_left(left, size)
        while k < len(left) and not holding[left[k]] & ~taken:
            k += 1
        if k < len(left):
            had = left[k]
            free = holding[had] & ~taken
            bit = free & -free
            holding[had] ^= bit
            if not holding[had]:
                del holding[had], left[k]
        else:
            had, bit = capacity, 1 << len(number)
            number.append(bins)
            bins += 1
        out.append((doc_id, piece, start, size, number[bit.bit_length() - 1], capacity - had))
        with_source[source] = with_source.get(source, 0) | bit
        if cluster in often:
            with_cluster[cluster] = with_cluster.get(cluster, 0) | bit
        if had - size not in holding:
            insort(left, had - size)
            holding[had - size] = 0
        holding[had - size] |= bit
    return out


def _packer(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        shard = None

        def done() -> pa.RecordBatch:
            rows = pack(held, capacity)
            rows = [(*r[:4], shard << 32 | r[4], r[5]) for r in rows]
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)], [x.split()[0] for x in _PIECES.split(", ")])

        for batch in batches:
            for s, copies, *item in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if s != shard:
                    if held:
                        yield done()
                    held, shard = [], s
                held += [tuple(item)] * copies
        if held:
            yield done()

    return run


def n_words(text: Column) -> Column:
    """How many runs of characters that are not white space."""
    return F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("long")


def best_fit(docs: DataFrame, cluster: Column | None = None, capacity: int = CAPACITY, text: str = "text", doc_id: str = "doc_id", source: str = "source", size: Column | None = None) -> DataFrame:
    """(doc_id, piece, start_token, n_tokens, bin_id, bin_offset) of every piece. cluster: a long column of duplicate clusters; as it stands, equal texts."""
    whole = text_of(text)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (n_words(whole) if size is None else size.cast("long")).alias("n_tokens"),
        F.col(source).cast("string").alias("source"),
        (F.xxhash64(whole) if cluster is None else cluster.cast("long")).alias("cluster"),
    )
    ship(docs.sparkSession)
    alike = cut(rows.groupBy("doc_id", "n_tokens", "source", "cluster").agg(F.count(F.lit(1)).alias("n")))
    shards = max(1, -(-(alike.agg(F.sum("n")).first()[0] or 0) // SHARD_DOCS))
    step = F.explode(F.sequence(F.lit(0), F.least("n", F.lit(shards)).cast("int") - 1))
    spread = alike.select("*", step.alias("step"))
    copies = F.floor(F.col("n") / shards) + (F.col("step") < F.col("n") % shards).cast("int")
    dealt = spread.select(F.pmod(F.xxhash64(F.lit(5), "doc_id", "cluster") % shards + F.col("step"), F.lit(shards)).alias("shard"), copies.cast("long").alias("copies"), "doc_id", "n_tokens", "source", "cluster")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(_packer(capacity), _PIECES)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"))
