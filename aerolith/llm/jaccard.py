"""N-gram Jaccard join: MinHash banding finds candidates, signatures thin them out, full shingle sets decide.

1. Each text gets a MinHash signature over its 5-word shingles, cut into bands. The number of bands and the rows of a band are the
   sharpest that reach RECALL at the wanted similarity (choose_bands). Equal texts are one node from here on.
2. Nodes meet by shuffling on band hashes. Within a bucket, cut into blocks if it is large, nodes are compared by a byte of each of
   their MinHash values, those of all bands: a pair goes on if as many agree as all but MISS of the pairs of the wanted similarity show. A
   group of a bucket emits the edges of a spanning forest, not its pairs. So texts that share a band by chance, or a template that
   makes up half of them, are not chained together.
3. The connected components of these edges hold every pair that went on. Each component's texts are verified pair by pair on their full
   shingle sets. A large component is cut into blocks by hash, and each pair of blocks is a group of its own, so that no task holds more
   than two blocks. A group emits a row per text: how many texts it is linked with, and the least text of its linked part; pairs are not
   emitted. A component of one block is thereby resolved; those of more are joined by a second run of components, over
   verified links only.

Words are runs of characters that are not white space (space and 9 to 13), as written. Texts of 1 to 4 words have one
shingle of all words. Shingles are told apart by 64-bit hashes. Two texts are linked if the Jaccard similarity
of their sets is 0.8 or more, reckoned in whole numbers.

Scale: what is shuffled for every text is its bands (8 bytes each), its signature (a byte for each hash) and, once, the text itself, which meets the
list of those in components. Hot bands are counted before they are joined, as partial minima; hot texts are one node. All joins are equi-joins that
adaptive execution can split. Nothing is collected and nothing broadcast by hand. A block has at most BLOCK texts and, but for single texts that are longer,
about BLOCK_BYTES. Verification of a component with m texts takes m * m / 2 comparisons, dealt over the pairs of its blocks; there is no cap on partners.

Defined cases: a null text is empty; texts without words are linked with nothing, but equal ones share a class. A null doc_id is the least of a
class only if all are null. Repeated rows are copies of each other. Ties do not arise: the least doc_id names a class. Other columns are ignored by
the join and pass through keep_one. Very long texts are read whole. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HASH_ROWS, cut, flat_bytes, fresh, mix, one_each, shingle_hashes, ship, table, text_of, word_hashes
from .graph import components

NGRAM = 5
SIMILARITY = Fraction(4, 5)
RECALL = 0.9995
MAX_HASHES = 160
#: The share of pairs of the wanted similarity that the comparison of signatures may miss.
MISS = 1e-4
#: Texts of a block, and about how many bytes of text. Nodes of a block of a bucket.
BLOCK = 256
BLOCK_BYTES = 8 << 20
BUCKET = 512
#: Shingles that are hashed at a time.
CHUNK = 1 << 17


def choose_bands(similarity: float = float(SIMILARITY), recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows, hence the fewest false candidates, whose bands reach the recall with at most so many hashes."""
    best = (1, 1)
    for rows in range(1, most + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(similarity**rows))))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def least_agreement(hashes: int, similarity: float = float(SIMILARITY), miss: float = MISS) -> int:
    """How many of so many bytes of a signature must agree: the most that all but a share of miss of the pairs of the similarity reach. Bytes of unlike shingles agree by chance once in 256 times."""
    p = similarity + (1 - similarity) / 256
    below = 0.0
    for k in range(hashes + 1):
        below += math.comb(hashes, k) * p**k * (1 - p) ** (hashes - k)
        if below > miss:
            return k
    return hashes


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    return seeds[:n] | np.uint64(1), seeds[n:]


def signatures(texts: pa.Array, bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles of each text, its band hashes, a byte of each MinHash); a text without words has none, its hashes mean nothing."""
    flat, starts = flat_bytes(texts)
    shingles, at = shingle_hashes(*word_hashes(flat, starts), NGRAM)
    counts = np.diff(at)
    a, b = _coefficients(bands * rows)
    out = np.zeros((len(counts), bands), np.uint64)
    low = np.zeros((len(counts), bands * rows), np.uint8)
    some = np.flatnonzero(counts)
    k = 0
    while k < len(some):
        j = max(k + 1, int(np.searchsorted(at, at[some[k]] + CHUNK, side="right")) - 1)
        j = max(k + 1, int(np.searchsorted(some, j)))
        part = some[k:j]
        begin, end = at[part[0]], at[part[-1] + 1]
        x, cuts = shingles[begin:end], at[part] - begin
        for band in range(bands):
            h = np.full(len(part), band + 1, np.uint64)
            for r in range(band * rows, (band + 1) * rows):
                least = np.minimum.reduceat(x * a[r] + b[r], cuts)
                h = mix(h ^ least)
                low[part, r] = mix(least).astype(np.uint8)
            out[part, band] = h
        k = j
    return counts, out, low


def _sign(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, HASH_ROWS):
                part = batch.slice(k, HASH_ROWS)
                counts, hashes, low = signatures(part.column(2), bands, rows)
                sizes = pc.binary_length(part.column(2)).cast(pa.int64())
                offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[counts > 0].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists, pa.array([x.tobytes() for x in low], pa.binary()), sizes], ["doc_id", "tkey", "bands", "low", "size"])

    return run


def _tkey(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _node(tkey: str) -> Column:
    """A 64-bit name of a text, used where a mistaken meeting of two would only add a candidate."""
    return F.xxhash64(tkey)


def _alike(hashes: int):
    """Edges of a spanning forest over each group's nodes whose signatures agree enough: (a, b), b the greater. A group is a block of a bucket, or two, of which only pairs across count."""
    least = least_agreement(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []

        def edges() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

        for group in _groups(batches, 3):
            node, at = np.unique(group.column("node").to_numpy(), return_index=True)
            if len(node) < 2:
                continue
            block = group.column("block").to_numpy()[at]
            low = np.frombuffer(b"".join(group.column("low").take(at).to_pylist()), np.uint8).reshape(len(node), hashes)
            agree = np.empty((len(node), len(node)), bool)
            for k in range(0, len(node), 64):
                agree[k : k + 64] = (low[k : k + 64, None, :] == low[None, :, :]).sum(axis=2, dtype=np.int16) >= least
            np.fill_diagonal(agree, False)
            if group.column("lo")[0].as_py() != group.column("hi")[0].as_py():
                agree &= block[:, None] != block[None, :]
            part = _parts(agree)
            own = np.flatnonzero(part != np.arange(len(node)))
            if len(own):
                a.append(node[part[own]])
                b.append(node[own])
            if sum(map(len, a)) > CHUNK:
                yield edges()
                a, b = [], []
        if a:
            yield edges()

    return run


def _in_blocks(members: DataFrame, key: str) -> DataFrame:
    """members, whose blocks column says into how many their key's group is cut, once for each pair of blocks that their own is part of: key, lo, hi, block and all else."""
    paired = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, as few bytes are much work here: not to be put together by size
    return paired.repartition(parts, key, "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def linked(texts: pa.Array, first: np.ndarray, cross: bool, similarity: Fraction = SIMILARITY) -> np.ndarray:
    """Which pairs of texts are linked, as a square matrix; of two blocks (first tells which) only pairs across."""
    flat, starts = flat_bytes(texts)
    shingles, at = shingle_hashes(*word_hashes(flat, starts), NGRAM)
    m = len(at) - 1
    own = np.repeat(np.arange(m), np.diff(at))
    order = np.lexsort((own, shingles))
    shingles, own = shingles[order], own[order]
    new = np.ones(len(own), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (own[1:] != own[:-1])
    shingles, own = shingles[new], own[new]
    sizes = np.bincount(own, minlength=m)
    starts_at = np.concatenate([[True], shingles[1:] != shingles[:-1]]) if len(shingles) else np.zeros(0, bool)
    column = np.cumsum(starts_at) - 1
    times = np.bincount(column) if len(column) else np.zeros(0, np.int64)
    shared = times[column] > 1 if len(column) else np.zeros(0, bool)
    own, column = own[shared], column[shared]
    if len(column):
        column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1
    both = np.zeros((m, m), np.int64)
    width = 4096
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [k, k + width])
        part = np.zeros((m, width), np.float32)
        part[own[lo:hi], column[lo:hi] - k] = 1
        both += (part @ part.T).astype(np.int64)
    p, q = similarity.numerator, similarity.denominator
    out = (both > 0) & ((p + q) * both >= p * (sizes[:, None] + sizes[None, :]))
    np.fill_diagonal(out, False)
    return out & (first[:, None] != first[None, :]) if cross else out


def _parts(links: np.ndarray) -> np.ndarray:
    """The least member of each member's connected part."""
    label = np.arange(len(links))
    while True:
        new = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first columns, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in range(keys)])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = values[:, lo].tolist()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in _groups(batches, 3):
        keys = group.column("tkey").to_pylist()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        order = [k for j, k in enumerate(order) if not j or keys[order[j - 1]] != keys[k]]  # repeated rows
        group = group.take(order)
        block = group.column("block").to_numpy()
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        found = linked(group.column("text").combine_chunks(), block, lo != hi)
        n = found.sum(axis=1)
        some = np.flatnonzero(n)
        if len(some):
            keys = [keys[k] for k in order]
            part = _parts(found)
            yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in some], pa.binary()), pa.array([keys[part[k]] for k in some], pa.binary()), pa.array(n[some], pa.int64()), pa.array([group.column("blocks")[0].as_py() > 1] * len(some))], ["tkey", "low", "n_links", "open"])


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): doc_id and tkey of every row; tkey, class_id, n_links and n_copies of every distinct text."""
    ship(docs.sparkSession)
    bands, band_rows = choose_bands()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    rows = rows.select("doc_id", _tkey(F.col("text")).alias("tkey"), "text")
    signed = cut(rows.mapInArrow(_sign(bands, band_rows), "doc_id long, tkey binary, bands array<long>, low binary, size long"))
    nodes = signed.groupBy("tkey").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_copies"))
    texts = signed.dropDuplicates(["tkey"]).withColumn("node", _node("tkey"))

    met = signed.select(_node("tkey").alias("node"), F.explode("bands").alias("h"))
    shared = met.groupBy("h").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most").select("h")
    met = cut(met.join(shared, "h").distinct())
    filled = met.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / BUCKET).cast("int").alias("blocks"))
    low = met.select("node").distinct().join(texts.select("node", "low"), "node")
    held = met.join(filled, "h").join(low, "node").withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
    dealt = _in_blocks(held, "h").select("h", "lo", "hi", "block", "node", "low")
    parts = cut(components(dealt.mapInArrow(_alike(bands * band_rows), "a long, b long")))

    own = texts.select("tkey", "node", "size").join(parts, "node")
    sizes = own.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("size") / BLOCK_BYTES)).cast("int").alias("blocks"))
    members = own.join(sizes, "root").join(nodes, "tkey").select("tkey", "rep", "root", F.greatest("blocks", F.lit(1)).alias("blocks"))

    at = members.withColumnRenamed("tkey", "of")  # by text and id together, so that a text with a third of all rows is no hot key
    found = rows.join(at, (F.col("tkey") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("rep")))
    found = found.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "tkey"), F.col("blocks")).cast("int"))
    dealt = _in_blocks(found.select("root", "block", "blocks", "tkey", "text"), "root").select("root", "lo", "hi", "block", "blocks", "tkey", "text")
    links = cut(dealt.mapInArrow(_verify, "tkey binary, low binary, n_links long, open boolean"))

    closed = links.filter("not open").select("tkey", F.col("low").alias("top"))
    across = components(links.filter("open").select(F.col("tkey").alias("a"), F.col("low").alias("b"))).select(F.col("node").alias("tkey"), F.col("root").alias("top"))
    total = links.groupBy("tkey").agg(F.sum("n_links").alias("n_links"))
    tops = nodes.join(closed.union(across), "tkey", "left").join(total, "tkey", "left")
    tops = tops.select("tkey", "rep", "n_copies", F.coalesce("top", "tkey").alias("top"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    named = tops.groupBy("top").agg(F.min("rep").alias("class_id"))
    return signed.select("doc_id", "tkey"), tops.join(named, "top").select("tkey", "class_id", "n_links", "n_copies", "top")


def jaccard_classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each row's class: doc_id, class_id (the least doc_id of all texts it is linked with, over any number of links), n_links (other texts that it is linked with itself), n_copies (rows of its own text)."""
    rows, nodes = classes(docs, text, doc_id)
    return rows.join(nodes, "tkey", "left").select("doc_id", "class_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs with one row of each class, that with the least doc_id; same columns. Of rows that repeat this doc_id, or of a class without any, one stays."""
    rows, nodes = classes(docs, text, doc_id)
    nodes = cut(nodes.select("tkey", "class_id", "top"))
    staying = rows.join(nodes, "tkey").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    again = cut(staying.groupBy("top").count().filter("count > 1").select(F.col("top").alias("of")))
    key, keep, group, repeated = fresh(docs, "tkey", "keep", "top", "repeated")
    some = not again.isEmpty()
    if some:
        nodes = nodes.join(again, F.col("top") == F.col("of"), "left")
    nodes = nodes.select(F.col("tkey").alias(key), F.col("class_id").alias(keep), F.col("top").alias(group), (F.col("of").isNotNull() if some else F.lit(False)).alias(repeated))
    own, *_ = fresh(docs.withColumns({x: F.lit(0) for x in (key, keep, group, repeated)}), "own")
    marked = docs.withColumn(own, _tkey(text_of(text)))
    kept = marked.join(nodes, (F.col(own) == F.col(key)) & F.col(doc_id).cast("long").eqNullSafe(F.col(keep)))
    return one_each(kept, group, repeated, docs.columns) if some else kept.select(*docs.columns)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


#: Every pair of texts that share a shingle, and the closure of the links among them. \x20 and \x09-\x0D part words.
OP7_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT text, min(doc_id) AS rep, count(*) AS n_copies FROM d GROUP BY text),
w AS (SELECT row_number() OVER (ORDER BY text) AS k, *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
s AS (SELECT k, unnest(list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' ')))) AS g FROM w WHERE len(ws) > 0),
n AS (SELECT k, count(*) AS n FROM s GROUP BY k),
both_ AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY a.k, b.k),
l AS (SELECT x, y FROM both_ JOIN n p ON p.k = x JOIN n q ON q.k = y WHERE 5 * c >= 4 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach AS (SELECT DISTINCT x AS k, x AS top FROM e UNION SELECT e.y, reach.top FROM reach JOIN e ON e.x = reach.k),
c AS (SELECT reach.k, min(w.rep) AS class_id FROM reach JOIN w ON w.k = reach.top GROUP BY reach.k),
m AS (SELECT x AS k, count(*) AS n_links FROM e GROUP BY x)
SELECT d.doc_id, CASE WHEN c.k IS NULL THEN w.rep ELSE c.class_id END AS class_id, coalesce(m.n_links, 0) AS n_links, w.n_copies
FROM d JOIN w USING (text) LEFT JOIN c ON c.k = w.k LEFT JOIN m ON m.k = w.k
"""
