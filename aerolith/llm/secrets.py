"""Secret scans: patterns, and a battery of randomness tests on every long token.

Base patterns (assignments, access keys, hex runs) are found as such. Beside them every token of MIN_TOKEN or more
characters of an encoding's alphabet is a candidate. The smallest alphabet that holds its characters is taken as its
encoding; its symbols' places in the alphabet are then tested for what random symbols would show: uniformity over the alphabet
(chi-squared, two-sided), runs above and below the alphabet's middle, and serial correlation of neighbours.

Two hypotheses frame the verdict, and each takes the three tests together, by Fisher's rule. Against "random": a token is dropped if the
three p-values together fall below REJECT. Against "ordinary text": each test has a p-value for how likely ordinary text of that length
and alphabet looks at least as random, and the three together are the token's p-value. A short token can look random by chance, a long one cannot. False
discoveries among all candidates of the corpus are held to FDR by the step-up rule of Benjamini and
Hochberg, for each class of lengths by itself. The rule's cutoffs come from a histogram of p-values over all documents.

What ordinary text looks like is counted, not assumed, over all documents. Neighbours of characters inside all tokens too short to be candidates
give, for each alphabet, the chi-squared noncentrality of a symbol, the rate of turns between the alphabet's halves and the correlation of neighbours. Then these short tokens, glued
within their document as they stand or with capitals, as identifiers are, and cut into windows of all lengths, go through the same battery: a p-value is never less than the share of windows
of its class of lengths that look as random. An alphabet with fewer than LEAST_PAIRS neighbours takes ASSUMED instead.

Scale: documents are not shuffled. One scan counts neighbours, one counts p-values, a third applies the cutoffs. What reaches the driver are tables
of fixed size, 66 x 66 neighbours and twice 8 x 401 p-values, summed over tasks, whatever the corpus holds. A task holds one
Arrow batch, and tests TOKENS candidates or CHARS characters at a time.

Defined cases: a null or empty text has no spans. Texts of any length are scanned whole, in time that grows with their length. Repeated rows are counted and
scanned alike. Ties: spans with one start are listed in the order assign, access, hex, random. A random span inside a base span of the same text is
not listed again. Other columns are left alone. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import HASH_ROWS, flat_bytes, fresh, ship, table, text_of

KINDS = ["assign", "access", "hex", "random"]
MIN_TOKEN = 20
FDR = 0.05
#: A token that the three tests together find unlike random symbols at this level is dropped.
REJECT = 0.001
#: Lower bounds of the classes of lengths.
LENGTHS = [20, 24, 28, 32, 40, 48, 64, 128]
#: Cells of a decade of p-values, and how many cells there are.
PER_DECADE, CELLS = 20, 401
#: Candidates, or characters of them, that are tested at a time.
TOKENS, CHARS = 4096, 1 << 19
ENCODINGS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Of an encoding's ordinary text: chi-squared noncentrality per symbol (for letters A * sum(p^2) - 1 of natural text; for hex and base 32 that of counters, dates and
#: padded numbers); mean, over the root of the length, and spread of the runs statistic; correlation of neighbours.
ASSUMED = np.array([[far, 0.0, 1.0, 0.0] for far in (1.0, 1.0, 1.1, 0.7, 1.3, 1.3, 2.2, 2.7, 2.8, 2.8)])
LEAST_PAIRS = 1000

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{%d,}" % MIN_TOKEN)
#: Which texts can hold a match at all; these run over the whole column in native code.
_MAY_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
_MAY_TOKEN = r"[A-Za-z0-9+/_-]{%d}" % MIN_TOKEN

_SETS = np.zeros((len(ENCODINGS), 128), np.int16) - 1
for _k, _alphabet in enumerate(ENCODINGS.values()):
    _SETS[_k, [ord(c) for c in _alphabet]] = np.arange(len(_alphabet))
_SIZES = np.array([len(a) for a in ENCODINGS.values()])
_CAPITAL = np.arange(256, dtype=np.uint8)
_CAPITAL[97:123] -= 32
_IN_TOKEN = np.zeros(256, bool)
_IN_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"]] = True
_erfc = np.vectorize(math.erfc, otypes=[float])


def _upper_tail(z: np.ndarray) -> np.ndarray:
    return _erfc(z / math.sqrt(2)) / 2 if len(z) else z


def _together(*p: np.ndarray) -> np.ndarray:
    """Fisher's rule for three p-values."""
    x = -sum(np.log(np.clip(v, 1e-300, 1.0)) for v in p)
    return np.minimum(np.exp(-x) * (1 + x + x * x / 2), 1.0)


def _ordinary(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, where texts begin, and which bytes lie inside tokens of fewer than MIN_TOKEN characters, and which of these follow another."""
    flat, starts = flat_bytes(texts)
    inside = _IN_TOKEN[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[starts] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    begin = np.flatnonzero(opens)
    sizes = np.add.reduceat(inside, begin, dtype=np.int64) if len(begin) else begin
    for k in np.flatnonzero(sizes >= MIN_TOKEN):  # candidates are not ordinary text
        inside[begin[k] : (begin[k + 1] if k + 1 < len(begin) else len(flat))] = False
    return flat, starts, inside, inside & ~opens


def neighbours(texts: pa.Array) -> np.ndarray:
    """How often each ASCII character follows each, inside tokens of fewer than MIN_TOKEN characters: 128 x 128."""
    flat, _, _, follows = _ordinary(texts)
    table = np.zeros(1 << 14, np.int64)
    for k in range(0, len(flat), CHARS):
        second = np.flatnonzero(follows[k : k + CHARS]) + k
        table += np.bincount(flat[second - 1].astype(np.int64) * 128 + flat[second], minlength=1 << 14)
    return table.reshape(128, 128)


def windows(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(characters, sizes) of windows of ordinary text: each text's short tokens, glued and cut into pieces of the lengths of LENGTHS, one after the other, every other one with a capital at each token's start; some at a time."""
    flat, starts, inside, follows = _ordinary(texts)
    ends = np.cumsum(LENGTHS)
    glued = np.concatenate([[0], np.cumsum(inside)])[starts]
    whole, rest = np.divmod(np.diff(glued), ends[-1])
    n = whole * len(LENGTHS) + np.searchsorted(ends, rest, side="right")
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    cycle, step = np.divmod(place, len(LENGTHS))
    begin, size = np.repeat(glued[:-1], n) + cycle * ends[-1] + (ends - LENGTHS)[step], np.array(LENGTHS)[step]
    chars, first = flat[inside], ~follows[inside]
    for k in range(0, len(begin), TOKENS):
        b, z = begin[k : k + TOKENS], size[k : k + TOKENS]
        at = np.repeat(b - (np.cumsum(z) - z), z) + np.arange(z.sum())
        capital = np.repeat((cycle + step)[k : k + TOKENS] % 2 == 1, z) & first[at]
        yield np.where(capital, _CAPITAL[chars[at]], chars[at]), z


def fitted(table: np.ndarray) -> np.ndarray:
    """What ordinary text of each encoding looks like, in the columns of ASSUMED, from the table of neighbours."""
    out = ASSUMED.copy()
    for k, alphabet in enumerate(ENCODINGS.values()):
        places = [ord(c) for c in alphabet]
        part = table[np.ix_(places, places)].astype(float)
        n = part.sum()
        if n < LEAST_PAIRS:
            continue
        part /= n
        p = (part.sum(axis=0) + part.sum(axis=1)) / 2
        size = len(alphabet)
        value = np.arange(size)
        high = value * 2 >= size
        turns = part[high][:, ~high].sum() + part[~high][:, high].sum()
        by_chance = max(2 * p[high].sum() * p[~high].sum(), 1e-3)
        mean = (p * value).sum()
        power = (p * (value - mean) ** 2).sum()
        both = ((value - mean)[:, None] * part * (value - mean)[None, :]).sum()
        out[k] = size * (p**2).sum() - 1, (turns - by_chance) / by_chance, max(math.sqrt(turns * (1 - turns)) / by_chance, 0.1), both / power if power > 0 else 0.0
    return out


def battery(chars: np.ndarray, sizes: np.ndarray, ordinary: np.ndarray = ASSUMED) -> tuple[np.ndarray, np.ndarray]:
    """For each token, of so many of the characters: its p-value against ordinary text (1 if no encoding fits or it is a number), and whether the tests together do not reject that its symbols are random."""
    if not len(sizes):
        return np.zeros(0), np.zeros(0, bool)
    own = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(sizes) - sizes
    fits = np.stack([np.minimum.reduceat(_SETS[k][chars], begin) >= 0 for k in range(len(ENCODINGS))])
    encoding = np.where(fits.any(axis=0), fits.argmax(axis=0), -1)
    usable = (encoding >= 0) & ~np.logical_and.reduceat((chars >= 48) & (chars <= 57), begin)
    encoding = np.maximum(encoding, 0)
    n, size = sizes.astype(float), _SIZES[encoding].astype(float)
    far, turn_mean, turn_spread, correlated = ordinary[encoding].T
    value = _SETS[encoding[own], chars].astype(np.int64)
    counts = np.bincount(own * 64 + np.clip(value, 0, 63), minlength=64 * len(sizes)).reshape(-1, 64).astype(float)
    chi = (counts**2).sum(axis=1) * size / n - n
    # random: chi-squared with size - 1 degrees of freedom, by the cube root of its mean
    free = size - 1
    z = (np.cbrt(chi / free) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
    p_chi = 2 * np.minimum(_upper_tail(z), _upper_tail(-z))
    # text: noncentral, lower tail
    t_chi = _upper_tail(-(chi - (free + n * far)) / np.sqrt(2 * free + 4 * n * far))
    # runs above and below the middle of the alphabet
    high = value * 2 >= size[own]
    highs = np.add.reduceat(high.astype(float), begin)
    lows = n - highs
    same = np.concatenate([[False], own[1:] == own[:-1]])
    turns = np.concatenate([[False], high[1:] != high[:-1]]) & same
    runs = np.add.reduceat(turns.astype(float), begin) + 1
    mean = 2 * highs * lows / n + 1
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    both = (highs > 0) & (lows > 0)
    z = np.abs(runs - mean) / spread
    p_runs = np.where(both, 2 * _upper_tail(z), 2.0 ** (1 - n))
    t_runs = np.where(both, _within(z + 0.5 / spread, turn_mean * np.sqrt(n), turn_spread), 1.0)  # runs are whole numbers
    # correlation of neighbours
    centred = value - (np.add.reduceat(value.astype(float), begin) / n)[own]
    power = np.add.reduceat(centred**2, begin)
    product = np.where(same, centred * np.concatenate([[0.0], centred[:-1]]), 0.0)
    serial = np.add.reduceat(product, begin) / np.maximum(power, 1e-9)
    z = np.abs(serial + 1 / n) * np.sqrt(n)
    p_serial = np.where(power > 0, 2 * _upper_tail(z), 0.0)
    t_serial = np.where(power > 0, _within(z, correlated * np.sqrt(n), np.ones(len(n))), 1.0)
    random = usable & (_together(p_chi, p_runs, p_serial) >= REJECT)
    return np.where(usable, _together(t_chi, t_runs, t_serial), 1.0), random


def _within(z: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """How likely a normal value of that mean and spread is no farther from 0 than z."""
    return _upper_tail((-z - mean) / spread) - _upper_tail((z - mean) / spread)


def of_tokens(tokens: list[str], ordinary: np.ndarray = ASSUMED) -> tuple[np.ndarray, np.ndarray]:
    return battery(np.frombuffer("".join(tokens).encode("ascii"), np.uint8), np.array([len(t) for t in tokens], np.int64), ordinary)


def _cells(p: np.ndarray) -> np.ndarray:
    """The cell of each p-value; a cell's upper edge is 10 ** (-cell / PER_DECADE)."""
    return np.minimum(np.floor(-np.log10(np.maximum(p, 1e-300)) * PER_DECADE + 1e-9), CELLS - 1).astype(np.int64)


def _length_class(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, sizes, side="right") - 1


def _candidates(texts: pa.Array, ordinary: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, begin, end, p-value and whether it may be random, of each candidate token, some at a time."""
    rows, spans, tokens, chars = [], [], [], 0

    def tested():
        return np.array(rows, np.int64), *np.array(spans, np.int64).reshape(-1, 2).T, *of_tokens(tokens, ordinary)

    for i in np.flatnonzero(pc.match_substring_regex(texts, _MAY_TOKEN).to_numpy(zero_copy_only=False)):
        for m in _TOKEN.finditer(texts[int(i)].as_py()):
            rows.append(int(i))
            spans.append(m.span())
            tokens.append(m[0])
            chars += len(m[0])
            if len(tokens) >= TOKENS or chars >= CHARS:
                yield tested()
                rows, spans, tokens, chars = [], [], [], 0
    if tokens:
        yield tested()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros((128, 128), np.int64)
    for batch in batches:
        for k in range(0, batch.num_rows, HASH_ROWS):
            table += neighbours(batch.column(0).slice(k, HASH_ROWS))
    a, b = np.nonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(table[a, b], pa.int64())], ["class", "cell", "n"])


def _histogram(ordinary: np.ndarray):
    """Counts of p-values by class of lengths: of candidates, and, as so many classes more, of windows of ordinary text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * len(LENGTHS) * CELLS, np.int64)

        def add(first: int, sizes: np.ndarray, p: np.ndarray) -> None:
            counts[:] += np.bincount((first + _length_class(sizes)) * CELLS + _cells(p), minlength=len(counts))

        for batch in batches:
            for k in range(0, batch.num_rows, HASH_ROWS):
                part = batch.column(0).slice(k, HASH_ROWS)
                for _, begin, end, p, _ in _candidates(part, ordinary):
                    add(0, end - begin, p)
                for chars, sizes in windows(part):
                    add(len(LENGTHS), sizes, battery(chars, sizes, ordinary)[0])
        (at,) = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at // CELLS, pa.int32()), pa.array(at % CELLS, pa.int32()), pa.array(counts[at], pa.int64())], ["class", "cell", "n"])

    return run


def _summed(docs: DataFrame, text: str, count, shape: tuple[int, int]) -> np.ndarray:
    """The table that count makes of all texts, added up; at most its size in rows reaches the driver."""
    cells = docs.select(text_of(text).alias("text")).mapInArrow(count, "class int, cell int, n long").groupBy("class", "cell").agg(F.sum("n").alias("n"))
    out = np.zeros(shape, np.int64)
    for r in cells.collect():
        out[r["class"], r["cell"]] = r["n"]
    return out


def step_up(counts: np.ndarray, windows: np.ndarray | None = None, fdr: float = FDR) -> np.ndarray:
    """For each class of lengths the smallest cell that passes: of the cells whose p-value is at most fdr times the share of candidates from it on, the one with the largest p-value. One beyond the last if none does.

    A cell's p-value is its upper edge, but not less than the share of windows of ordinary text that lie in it or in cells beyond.
    """
    out = np.full(len(counts), counts.shape[1])
    edges = 10.0 ** (-np.arange(counts.shape[1]) / PER_DECADE)
    for k, row in enumerate(counts):
        total = row.sum()
        upto = row[::-1].cumsum()[::-1]
        p = edges
        if windows is not None and windows[k].any():
            p = np.maximum(edges, windows[k][::-1].cumsum()[::-1] / windows[k].sum())
        ok = np.flatnonzero((upto > 0) & (p * total <= fdr * upto))
        if len(ok):
            out[k] = ok[0]
    return out


def prepared(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, list[int]]:
    """What ordinary text looks like, and the cell of p-values from which on candidates of each class of lengths pass; over all documents."""
    ship(docs.sparkSession)
    ordinary = fitted(_summed(docs, text, _neighbours, (128, 128)))
    counts = _summed(docs, text, _histogram(ordinary), (2 * len(LENGTHS), CELLS))
    return ordinary, step_up(counts[: len(LENGTHS)], counts[len(LENGTHS) :]).tolist()


def _spans(texts: pa.Array, ordinary: np.ndarray, passing: list[int]) -> list[list[tuple[int, int, int, int, int]]]:
    """Of each text (start, kind, end, start and end of the secret itself), sorted."""
    out: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(len(texts))]
    flagged = lambda mask: np.flatnonzero(mask.to_numpy(zero_copy_only=False))
    for i in flagged(pc.match_substring_regex(texts, _MAY_ASSIGN)):
        out[i] += [(m.start(), 0, m.end(), *m.span(2)) for m in _ASSIGN.finditer(texts[int(i)].as_py()) if m.end(2) - m.start(2) >= 6]
    for i in flagged(pc.match_substring(texts, "AKIA")):
        out[i] += [(m.start(), 1, m.end(), *m.span()) for m in _ACCESS.finditer(texts[int(i)].as_py()) if len(m[0]) >= 20]
    for i in flagged(pc.match_substring_regex(texts, "[0-9a-f]{24}")):
        out[i] += [(m.start(), 2, m.end(), *m.span()) for m in _HEX.finditer(texts[int(i)].as_py())]
    found: dict[int, list[tuple[int, int]]] = {}
    limit = np.array(passing)
    for rows, begin, end, p, random in _candidates(texts, ordinary):
        good = np.flatnonzero(random & (_cells(p) >= limit[_length_class(end - begin)]))
        for i, a, b in zip(rows[good].tolist(), begin[good].tolist(), end[good].tolist(), strict=True):
            found.setdefault(i, []).append((a, b))
    for i, spans in found.items():
        base = sorted(out[i])
        k, reach = 0, -1  # base spans that begin no later than a, and how far they reach
        for a, b in spans:
            while k < len(base) and base[k][0] <= a:
                reach = max(reach, base[k][2])
                k += 1
            if b > reach:
                out[i].append((a, 3, b, a, b))
    for x in out:
        x.sort()
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, *_ in spans)


def redact(text: str, spans: list[tuple[int, int, int, int, int]], mask: str = "[SECRET]") -> str:
    """text with every secret, overlapping ones together, replaced by the mask."""
    out, at, hidden = [], 0, None
    for begin, end in sorted((s[3], s[4]) for s in spans):
        if hidden is not None and begin <= hidden[1]:
            hidden = (hidden[0], max(hidden[1], end))
            continue
        if hidden is not None:
            out += [text[at : hidden[0]], mask]
            at = hidden[1]
        hidden = (begin, end)
    if hidden is not None:
        out += [text[at : hidden[0]], mask]
        at = hidden[1]
    return "".join(out) + text[at:]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, found array<struct<kind,start,end,secret>>) of every row."""
    ordinary, passing = prepared(docs, text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    schema = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = [[{"kind": KINDS[k], "start": a, "end": b, "secret": texts[i].as_py()[c:d]} for a, k, b, c, d in x] for i, x in enumerate(_spans(texts, ordinary, passing))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, schema)], ["doc_id", "found"])

    return rows.mapInArrow(run, "doc_id long, found array<struct<kind:string,start:long,end:long,secret:string>>")


def scan_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row."""
    ordinary, passing = prepared(docs, text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _spans(batch.column(1), ordinary, passing)
            count = [pa.array([sum(s[1] == k for s in x) for x in found], pa.int64()) for k in range(4)]
            base = [_joined(s for s in x if s[1] < 3) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *count[:3], pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()), pa.array([_joined(x) for x in found], pa.string()), count[3]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])

    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def mask_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """docs with every secret replaced by a mask, and n_chars, if there is such a column, brought up to date; all rows stay."""
    ordinary, passing = prepared(docs, text)
    (masked,) = fresh(docs, "masked")
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(at), "")
            found = _spans(texts, ordinary, passing)
            new = texts
            if any(found):
                new = pa.array([redact(texts[i].as_py(), x) if x else texts[i].as_py() for i, x in enumerate(found)], texts.type)
            new = pc.if_else(pc.is_null(batch.column(at)), pa.scalar(None, texts.type), new)
            yield pa.RecordBatch.from_arrays([*batch.columns, new], schema=pa.schema([*batch.schema, pa.field(masked, texts.type)]))

    out = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(masked, T.StringType())]))
    changed = ~F.col(masked).eqNullSafe(F.col(text))
    cols = [F.col(masked).alias(c) if c == text else F.when(changed, F.length(masked)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == n_chars else F.col(c) for c in docs.columns]
    return out.select(*cols)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_digests(table(spark, sf_dir, "documents"))
