"""BPE encoding and decoding of whole texts, by batched numpy merge rounds.

A batch of texts is normalised and split into words as the vocabulary file says; each distinct word is encoded once. The
symbols of all new words lie in one flat array. In each round the pairs of neighbours are looked up by binary search over the
sorted pair keys of the merge table, each word's pairs of the lowest rank are merged, left to right, in all
words at once, and the array is closed up. Rounds end when no pair of any word is in the table.

Scale: texts are not shuffled; a task holds one Arrow batch and a table of the words it has met, which is emptied beyond
CACHE_WORDS entries. Nothing is collected. Each batch stands alone, so lost executors cost only their own tasks.

Defined cases: a null or empty text has no tokens; its ids and its decoded text are empty. Texts of any length are
encoded whole. Repeated rows are encoded alike. Special tokens written in a text become their ids, as the file's flags say. Other
columns pass through; a table without rows gives none.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, table, text_of

CACHE_WORDS = 600_000
_SPACES = "\t-\r\x20\x85\xa0  -     　"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary: itself where printable, else the next from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class WordBPE:
    """A tokenizer of words with an end-of-word suffix, read from a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, merges, suffix = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]], model["end_of_word_suffix"]
        self.tokens = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")")
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        parts = "'s|'t|'re|'ve|'m|'ll|'d|{letters}+|{digit}|[^{space}{others}]+"
        self.words = regex.compile(parts.format(letters=r"[\p{L}]", digit=r"[\p{N}]", space=_SPACES, others=r"\p{L}\p{N}"))
        self.ascii_words = re.compile(parts.format(letters="[a-z]", digit="[0-9]", space=_SPACES[:5], others="a-z0-9"))
        #: Of each word met (and each special token, under its id): its ids and its decoded text.
        self.ids_of: dict[str | int, str] = {}
        self.text_of: dict[str | int, str] = {}
        self._forget()

    def _forget(self) -> None:
        self.ids_of = {i: str(i) for i in self.special.values()}
        self.text_of = {i: self.tokens[i] for i in self.special.values()}

    def split(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        # a lower-case sigma does not depend on its place here
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """The ids of each word."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        sizes = np.array([len(x) for x in raw])
        symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        final = np.zeros(len(symbols), bool)
        final[np.cumsum(sizes) - 1] = True
        symbols = np.where(final, self.last[symbols], self.first[symbols])
        done_symbols, done_words = [], []
        while len(symbols):
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & (word[:-1] == word[1:]), self.ranks[at], len(self.keys))
            lowest = np.full(len(words), len(self.keys))
            np.minimum.at(lowest, word[:-1], rank)
            open_ = lowest[word] < len(self.keys)
            done_symbols.append(symbols[~open_])
            done_words.append(word[~open_])
            hit = (rank < len(self.keys)) & (rank == lowest[word[:-1]])
            where = np.flatnonzero(hit)
            if len(where):  # of overlapping pairs such as a a a, every second counts, from the left
                run = np.concatenate([[True], (np.diff(where) > 1) | (word[where[1:]] != word[where[:-1]])])
                begin = where[run][np.cumsum(run) - 1]
                where = where[(where - begin) % 2 == 0]
            symbols = symbols.copy()
            symbols[where] = self.merged[rank[where]]
            stay = open_.copy()
            stay[where + 1] = False
            symbols, word = symbols[stay], word[stay]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.split(symbols[order], np.cumsum(np.bincount(word, minlength=len(words)))[:-1])

    def learn(self, words: set[str | int]) -> None:
        """Encodes the words that are not known yet."""
        new = [w for w in words if w not in self.ids_of]
        token = self.tokens.__getitem__
        for k in range(0, len(new), 50_000):
            part = new[k : k + 50_000]
            for w, found in zip(part, self.encode_words(part), strict=True):
                ids = found.tolist()
                self.ids_of[w] = " ".join(map(str, ids))
                self.text_of[w] = " ".join(map(token, ids))

    def pieces(self, text: str) -> list[str | int]:
        """The words of a text, with the ids of the special tokens written in it."""
        if "<|" not in text:
            return self.split(text)
        out: list[str | int] = []
        for part in self.at_special.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self.split(part)
        return out

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """(number of tokens, ids joined by a space, decoded text) of each text."""
        if len(self.ids_of) > CACHE_WORDS:
            self._forget()
        words = [self.pieces(t) for t in texts]
        self.learn(set().union(*words))
        ids_of, text_of = self.ids_of.__getitem__, self.text_of.__getitem__
        for w in words:
            ids = " ".join(map(ids_of, w))
            yield ids.count(" ") + bool(ids), ids, " ".join(map(text_of, w))

    def encode(self, text: str) -> list[int]:
        ((_, ids, _),) = self.digests([text])
        return [int(x) for x in ids.split()]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a space, special ones included; the file names no decoder. Ids beyond the vocabulary are left out."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@functools.cache
def word_bpe(path: str) -> WordBPE:
    """The tokenizer, read once by each Python worker."""
    return WordBPE(path)


def encode(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) of every row: the operator itself, with its real outputs."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(vocabulary)
        for batch in batches:
            found = list(bpe.digests(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[int(i) for i in x[1].split()] for x in found], pa.list_(pa.int32())), pa.array([x[2] for x in found], pa.string())], ["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row, without carrying the ids out of the task."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(vocabulary)
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                out = [(n, sha(ids), sha(decoded)) for n, ids, decoded in bpe.digests(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(list(x), kind) for x, kind in zip(zip(*out, strict=True), (pa.int64(), pa.string(), pa.string()), strict=True)]], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
