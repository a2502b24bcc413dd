"""Language-model scoring by cross-entropy difference.

Two bigram models, of the target and of the background, share one vocabulary: the words, with A-Z in lower case, and the pairs of neighbours. They are counted
one by one, under keys of 64 bits: two of a thousand million keys share one with a chance of 3 %. The models grow with the corpus. They are matched: equal order, equal smoothing, and relative counts
throughout, so that the size of either corpus does not matter by itself. The target is all rows labelled as of high
quality, the background all rows. A document's score is the mean over its tokens of the difference of the two losses, loss under the target
less loss under the background, in nats: the lower, the more like the target.

A word's probability after another mixes three estimates: PAIR * count(pair) / count(first) + (1 - PAIR) * (WORD *
count(word) / all words + (1 - WORD) / 2**WORD_BITS), the last a fixed share for any word; after a word that was never seen only the latter two count. A text begins after a mark that is no word.

Every document is scored by models that do not hold it: its own counts are taken off the background, and off the target if it belongs to it. Else each
document of the target would be found to be like itself, and only documents outside it would be judged.

Scale: counts cover every token of every document. Documents are dealt by doc_id to chunks of about CHUNK bytes, as are the marks of the target. Each chunk asks for the
counts of its own keys, each key once, giving its own; a range of keys is summed up over all chunks and the sums go back to the chunks that asked. So a hot word
is a row per chunk, nothing is broadcast or collected but the number of chunks, and the texts are shuffled twice. A task holds the keys of a chunk, or of a range, of which there are as many.

Defined cases: a null or empty text has no tokens; its losses and score are null. Texts of any length are scored
whole. A row without label, or with a null one, belongs to the background alone; of several labels of a doc_id the
highest counts; a null doc_id has no label. Repeated rows count each. Without any target row the target's counts are empty and its model uniform.
Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HASH_ROWS, cut, flat_bytes, mix, ship, table, text_of, word_hashes

WORD_BITS, PAIR_BITS = 18, 20
PAIR, WORD = 0.6, 0.95
SLICE = 1 << 14
SALTS = 32
BEGIN = np.uint64(0x5851F42D4C957F2D)
TOTAL = np.uint64(0x14057B7EF767814F)  # the key under which tokens are counted
#: Bytes of text in a chunk, about, and keys that a task gathers before it adds them up.
CHUNK = 12 << 20
FLUSH = 1 << 21
_WORDS, _CELLS = 1 << WORD_BITS, (1 << WORD_BITS) + 1 + (1 << PAIR_BITS)  # words, the mark of a beginning, pairs


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token its word cell, the cell of the one before and the cell of the pair; and where each text's tokens begin."""
    flat, starts = flat_bytes(texts)
    flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    words, at = word_hashes(flat, starts)
    before = np.concatenate([[BEGIN], words[:-1]]) if len(words) else words
    first = at[:-1][np.diff(at) > 0]
    before[first] = BEGIN
    word = (words >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    previous = (before >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    previous[first] = _WORDS
    pair = (mix(before * np.uint64(3) + words) >> np.uint64(64 - PAIR_BITS)).astype(np.int64) + _WORDS + 1
    return word, previous, pair, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, _CELLS), np.int64)
    for batch in batches:
        for k in range(0, batch.num_rows, HASH_ROWS):
            part = batch.slice(k, HASH_ROWS)
            word, _, pair, at = _tokens(part.column(0))
            sizes = np.diff(at)
            chosen = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
            token = np.repeat(chosen, sizes)
            for model, some in ((0, token), (1, None)):
                w, p, begun = (word, pair, (sizes > 0).sum()) if some is None else (word[some], pair[some], ((sizes > 0) & chosen).sum())
                counts[model] += np.bincount(w, minlength=_CELLS) + np.bincount(p, minlength=_CELLS)
                counts[model, _WORDS] += begun
    yield from _slices(counts)


def _slices(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for model in range(2):
        for k in range(0, _CELLS, SLICE):
            part = counts[model, k : k + SLICE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([model * (_CELLS // SLICE + 1) + k // SLICE], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "counts"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(data.as_buffer(), np.int64)
            sums[k] = sums[k] + part if k in sums else part.copy()
    for k, part in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["slice", "counts"])


def count_models(rows: DataFrame) -> np.ndarray:
    """The counts of (target, background) over rows (text, chosen) in hashed cells: 2 x cells. A table of fixed size; score does not use it."""
    schema = "slice int, counts binary"
    parts = rows.select("text", "chosen").mapInArrow(_count, schema)
    parts = parts.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).repartition("slice", "salt").select("slice", "counts").mapInArrow(_sum, schema)
    parts = parts.repartition("slice").mapInArrow(_sum, schema)
    out = np.zeros((2, _CELLS), np.int64)
    per = _CELLS // SLICE + 1
    for r in parts.toLocalIterator():  # 2 * per rows of at most 8 * SLICE bytes
        at = r["slice"] % per * SLICE
        part = np.frombuffer(r["counts"], np.int64)
        out[r["slice"] // per, at : at + len(part)] = part
    return out


def _own(cells: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """How often each token's cell, of size cells, occurs in its own document."""
    _, which, n = np.unique(doc * np.int64(size) + cells, return_inverse=True, return_counts=True)
    return n[which]


def losses(all_words: np.ndarray, word: np.ndarray, previous: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The loss of each token, in nats, from the counts of its word, of the one before and of the pair, and of all words."""
    single = WORD * word / np.maximum(all_words, 1.0) + (1 - WORD) / _WORDS
    p = np.where(previous > 0, PAIR * pair / np.maximum(previous, 1.0) + (1 - PAIR) * single, single)
    return -np.log(np.minimum(p, 1.0))


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 64 bits, compressed byte by byte: the high bytes, nearly all equal, take next to nothing. After their own size in bytes."""
    flat = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(flat).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(flat, asbytes=True)


def _unpacked(data: bytes, kind: type = np.int64) -> np.ndarray:
    flat = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    return np.frombuffer(flat, np.uint8).reshape(8, -1).T.copy().view(kind).ravel()


def _steps(keys: np.ndarray) -> np.ndarray:
    """Rising keys as the first and the differences."""
    return np.diff(keys, prepend=np.uint64(0))


def _keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every token the 64-bit keys of its word, of the one before and of the pair; and where each text's tokens begin."""
    flat, starts = flat_bytes(texts)
    flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    words, at = word_hashes(flat, starts)
    before = np.concatenate([[BEGIN], words[:-1]]) if len(words) else words
    before[at[:-1][np.diff(at) > 0]] = BEGIN
    return words, before, mix(before * np.uint64(3) + words), at


def _dealt(parts: list[DataFrame], chunks: int) -> DataFrame:
    """Rows of a chunk in one partition, marks first, then counts, then texts."""
    schema = {"chunk": "int", "kind": "int", "doc_id": "bigint", "text": "string", "part": "int", "target": "binary", "all": "binary"}
    rows = None
    for p in parts:
        p = p.select(*[F.col(c).cast(t) if c in p.columns else F.lit(None).cast(t).alias(c) for c, t in schema.items()])
        rows = p if rows is None else rows.unionAll(p)
    return rows.repartitionById(chunks, "chunk").sortWithinPartitions("chunk", "kind", "part", "doc_id")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(chunk, kind, rows) of each run of rows of one chunk and kind, HASH_ROWS at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        chunk, kind = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        ends = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1
        for lo, hi in zip([0, *ends], [*ends, batch.num_rows], strict=True):
            for k in range(lo, hi, HASH_ROWS):
                yield int(chunk[lo]), int(kind[lo]), batch.slice(k, min(HASH_ROWS, hi - k))


def _members(ids: pa.Array, marks: np.ndarray) -> np.ndarray:
    return np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), marks) & ids.is_valid().to_numpy(zero_copy_only=False)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, and how often it occurs. By a plain sort, some twenty times as fast as the hash table of np.unique."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


def _added(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each key once, in order, and the sums of its counts."""
    if not len(keys):
        return (keys, *counts)
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *[np.add.reduceat(c[order], first) for c in counts])


def _places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key stands among keys, which hold it. Each distinct one is looked up once, in order."""
    each, which = np.unique(wanted, return_inverse=True)
    return np.searchsorted(keys, each)[which]


def _ask(chunks: int):
    """The counts of each chunk's own words, beginnings, pairs and of all its tokens, parted by ranges of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, marks, raw, chosen_raw, sums, waiting = None, [], [], [], [], 0

        def settle():
            """Adds up the tokens gathered: those of all, and those of the target, whose keys are among them."""
            nonlocal raw, chosen_raw, sums, waiting
            if raw:
                keys, whole = _distinct(np.concatenate(raw))
                some, n = _distinct(np.concatenate(chosen_raw))
                target = np.zeros(len(keys), np.int64)
                target[np.searchsorted(keys, some)] = n
                sums = [_added(*[np.concatenate(x) for x in zip(*sums, (keys, target, whole), strict=True)])]
            raw, chosen_raw, waiting = [], [], 0

        def asked():
            settle()
            if sums:
                keys, target, whole = sums[0]
                edges = np.searchsorted(_part(keys, chunks), np.arange(chunks + 1))
                for p in np.flatnonzero(np.diff(edges)):
                    one = slice(edges[p], edges[p + 1])
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([now], pa.int32()), *[pa.array([_packed(x)], pa.binary()) for x in (_steps(keys[one]), target[one], whole[one])]], ["part", "chunk", "keys", "target", "all"])

        for chunk, kind, part in _runs(batches):
            if chunk != now:
                yield from asked()
                now, marks, raw, chosen_raw, sums, waiting = chunk, [np.zeros(0, np.int64)], [], [], [], 0
            if kind == 0:
                marks.append(part.column(2).to_numpy(zero_copy_only=False))
                continue
            marks = [np.concatenate(marks)]
            words, _, pair, at = _keys(part.column(3))
            sizes = np.diff(at)
            if not len(words):
                continue
            chosen = _members(part.column(2), marks[0])
            token = np.repeat(chosen, sizes)
            for into, w, p, begun in ((raw, words, pair, sizes > 0), (chosen_raw, words[token], pair[token], (sizes > 0) & chosen)):
                into += [w, p, np.full(begun.sum(), BEGIN)]
            sums.append((np.array([TOTAL]), np.array([token.sum()]), np.array([len(words)])))
            waiting += 2 * len(words)
            if waiting > FLUSH:
                settle()
        yield from asked()

    return run


def _part(keys: np.ndarray, chunks: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(chunks) >> np.uint64(32)).astype(np.int64)


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums up a range of keys over all chunks, and gives each chunk the sums of the keys that it asked for, in their order."""
    asked = [(p, c, np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64), _unpacked(t), _unpacked(a)) for b in batches for p, c, k, t, a in zip(*[x.to_pylist() for x in b.columns], strict=True)]
    for p in sorted({x[0] for x in asked}):
        own = [x for x in asked if x[0] == p]
        keys, *sums = _added(*[np.concatenate([x[m] for x in own]) for m in (2, 3, 4)])
        for _, c, k, _, _ in own:
            at = np.searchsorted(keys, k)
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([c], pa.int32()), *[pa.array([_packed(x[at])], pa.binary()) for x in sums]], ["part", "chunk", "target", "all"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores each chunk's texts. They are gone through twice: once for the keys that the chunk had asked for, to which the counts belong in order, once to be scored."""
    for _, runs in groupby(_runs(batches), lambda x: x[0]):
        marks, got, keys, waiting, writer = [np.zeros(0, np.int64)], [], [], 0, None
        with tempfile.SpooledTemporaryFile(max_size=4 * CHUNK) as texts:  # a chunk is larger only where rows repeat a doc_id
            for _, kind, part in runs:
                if kind == 0:
                    marks.append(part.column(2).to_numpy(zero_copy_only=False))
                elif kind == 1:
                    got += zip(*[[_unpacked(x) for x in part.column(k).to_pylist()] for k in (5, 6)], strict=True)
                else:
                    part = part.select([2, 3])
                    writer = writer or pa.ipc.new_stream(texts, part.schema)
                    writer.write_batch(part)
                    words, _, pair, _ = _keys(part.column(1))
                    if len(words):
                        keys += [words, pair, np.array([BEGIN, TOTAL])]
                        waiting += 2 * len(words)
                    if waiting > FLUSH:
                        keys, waiting = [_distinct(np.concatenate(keys))[0]], 0
            if writer is None:
                continue
            writer.close()
            texts.seek(0)
            known = _distinct(np.concatenate(keys))[0] if keys else np.zeros(0, np.uint64)
            counts = [np.concatenate([x[m] for x in got]) if got else np.zeros(0, np.int64) for m in range(2)]
            assert len(counts[0]) == len(known)
            del got, keys
            member = np.concatenate(marks)
            for part in pa.ipc.open_stream(texts):
                yield _scores(part, member, known, counts)


def _scores(part: pa.RecordBatch, marks: np.ndarray, keys: np.ndarray, tables: list[np.ndarray]) -> pa.RecordBatch:
    words, _, pair, at = _keys(part.column(1))
    n = np.diff(at)
    none = n == 0
    doc = np.repeat(np.arange(len(n)), n)
    word, pair = _places(keys, words), _places(keys, pair)
    own_word, own_pair = _own(word, doc, len(keys)), _own(pair, doc, len(keys))
    previous, own_previous = (np.concatenate([[0], x[:-1]]) if len(word) else x for x in (word, own_word))
    first = at[:-1][~none]
    previous[first], own_previous[first] = np.searchsorted(keys, BEGIN), 1  # the mark of the beginning
    member = _members(part.column(0), marks).astype(np.int64)
    mean = []
    for counts, held in zip(tables, (member[doc], np.ones(len(doc), np.int64)), strict=True):
        less = lambda at_, own, counts=counts, held=held: (counts[at_] - own * held).astype(float)
        total = counts[np.searchsorted(keys, TOTAL)] if len(doc) else 0
        loss = losses((total - n[doc] * held).astype(float), less(word, own_word), less(previous, own_previous), less(pair, own_pair))
        sums = np.zeros(len(n))  # each document by itself, so that its mean does not depend on the rows before it
        if len(loss):
            sums[~none] = np.add.reduceat(loss, first)
        mean.append(sums / np.maximum(n, 1))
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *[pa.array(x, pa.float64(), mask=none) for x in (*mean, mean[0] - mean[1])]], ["doc_id", "n_tokens", "loss_target", "loss_background", "score"])


def score(docs: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, loss_target, loss_background, score) of every row of docs; chosen holds the doc_ids of the target, each once."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK))
    of_id = F.pmod(F.xxhash64("doc_id"), F.lit(chunks))
    texts = rows.select(F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("text"), F.lit(chunks))).otherwise(of_id).alias("chunk"), F.lit(2).alias("kind"), "doc_id", "text")
    marks = chosen.select(F.col("doc_id").cast("long").alias("doc_id")).select(of_id.alias("chunk"), F.lit(0).alias("kind"), "doc_id")
    asked = _dealt([marks, texts], chunks).mapInArrow(_ask(chunks), "part int, chunk int, keys binary, target binary, all binary")
    counts = asked.repartitionById(chunks, "part").mapInArrow(_answer, "part int, chunk int, target binary, all binary").withColumn("kind", F.lit(1))
    return _dealt([marks, texts, counts], chunks).mapInArrow(_scored, "doc_id long, n_tokens long, loss_target double, loss_background double, score double")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    chosen = cut(labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1").select("doc_id"))
    return score(table(spark, sf_dir, "documents"), chosen)
