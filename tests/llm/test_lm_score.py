import math
import random
import re

import numpy as np
import pytest

from aerolith.llm import lm_score as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, target):
    """Plain dictionaries instead of hashed cells, counted anew without each document; equal as long as no two words share a cell."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [WORD.findall((t or "").translate(low)) for _, t in rows]
    def count(some):
        one, two, n = {}, {}, 0
        for words in some:
            if words:
                one[None] = one.get(None, 0) + 1
                for a, b in zip([None, *words], words, strict=False):
                    one[b] = one.get(b, 0) + 1
                    two[a, b] = two.get((a, b), 0) + 1
                    n += 1
        return one, two, n

    out = []
    for k, (i, _) in enumerate(rows):
        words, means = tokens[k], []
        for chosen in (lambda i: i in target, lambda i: True):
            one, two, n = count([w for j, w in enumerate(tokens) if j != k and chosen(rows[j][0])])
            total = 0.0
            for a, b in zip([None, *words], words, strict=False):
                p1 = M.WORD * one.get(b, 0) / max(n, 1) + (1 - M.WORD) / M._WORDS
                p = M.PAIR * two.get((a, b), 0) / one[a] + (1 - M.PAIR) * p1 if one.get(a) else p1
                total -= math.log(p)
            means.append(total / len(words) if words else None)
        out.append((i, len(words), *means, means[0] - means[1] if words else None))
    return out


def test_against_brute_force(spark, docs, with_clashes):
    rng = random.Random(1)
    vocabulary = [f"Word{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choices(vocabulary[: 20 if k % 2 else 60], k=rng.randint(1, 80)))) for k in range(60)] + [(100, None), (101, ""), (102, " one "), (3, "again")]
    chosen = spark.createDataFrame([(k,) for k in range(1, 60, 2)], "doc_id long")
    got = M.score(with_clashes(docs(*rows)), chosen).collect()
    want = brute(rows, set(range(1, 60, 2)))
    key = lambda r: (r[0], r[1])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and (a[2:] == b[2:] if b[2] is None else a[2:] == pytest.approx(b[2:], rel=1e-9)), a


def test_held_out_separation(spark, docs):
    rng = random.Random(9)
    good, bad = [f"g{k}" for k in range(200)], [f"b{k}" for k in range(200)]
    make = lambda words: " ".join(rng.choices(words, k=60))
    rows = [(k, make(good)) for k in range(100)] + [(500 + k, make(bad)) for k in range(100)]
    scores = {r.doc_id: r.score for r in M.score(docs(*rows), spark.createDataFrame([(k,) for k in range(50)], "doc_id long")).collect()}
    held, other = [scores[k] for k in range(50, 100)], [scores[500 + k] for k in range(100)]
    assert max(held) < min(other)


def test_counts_cover_every_token(docs, spark):
    from pyspark.sql import functions as F

    df = docs(*[(k, "a b c") for k in range(500)]).select("text", (F.col("doc_id") < 10).alias("chosen")).repartition(7)
    counts = M.count_models(df)
    assert counts[:, : M._WORDS].sum(axis=1).tolist() == [30, 1500] and counts[:, M._WORDS].tolist() == [10, 500] and counts[:, M._WORDS + 1 :].sum(axis=1).tolist() == [30, 1500]
    assert counts.dtype == np.int64


def test_no_target_and_empty(spark, docs):
    none = spark.createDataFrame([], "doc_id long")
    (r,) = M.score(docs((1, "a b")), none).collect()
    assert r.loss_target == pytest.approx(-math.log((1 - M.WORD) / M._WORDS))
    assert M.score(docs(), none).count() == 0


@pytest.mark.parametrize("size", [1 << 14, 1 << 24])
def test_more_words_than_cells(spark, docs, monkeypatch, size):
    """Counts are of words and pairs, not of cells that strangers share."""
    monkeypatch.setattr(M, "CHUNK", size, raising=False)
    rng = random.Random(4)
    rows = [(k, " ".join(f"w{rng.randrange(400_000)}" if rng.random() < 0.9 else f"w{rng.randrange(50)}" for _ in range(3000))) for k in range(120)]
    rows += [(None, rows[0][1]), (7, "w1 w2 w1"), (None, None)]
    target = set(range(0, 120, 3))
    one, two, n = [{}, {}], [{}, {}], [0, 0]
    tokens = [(t or "").split() for _, t in rows]

    def add(words, m, sign):
        for a, b in zip([None, *words], words, strict=False):
            one[m][b] = one[m].get(b, 0) + sign
            two[m][a, b] = two[m].get((a, b), 0) + sign
        one[m][None] = one[m].get(None, 0) + sign * bool(words)
        n[m] += sign * len(words)

    for (i, _), words in zip(rows, tokens, strict=True):
        for m in range(2 if i in target else 1):
            add(words, 1 - m, 1)
    want = []
    for (i, _), words in zip(rows, tokens, strict=True):
        means = []
        for m in range(2):
            held = m == 1 or i in target
            if held:
                add(words, m, -1)
            total = 0.0
            for a, b in zip([None, *words], words, strict=False):
                p1 = M.WORD * one[m].get(b, 0) / max(n[m], 1) + (1 - M.WORD) / M._WORDS
                total -= math.log(M.PAIR * two[m].get((a, b), 0) / one[m][a] + (1 - M.PAIR) * p1 if one[m].get(a) else p1)
            means.append(total / len(words) if words else None)
            if held:
                add(words, m, 1)
        want.append((i, len(words), *means, means[0] - means[1] if words else None))
    key = lambda r: (str(r[0]), r[1])
    got = sorted(map(tuple, M.score(docs(*rows), spark.createDataFrame([(k,) for k in target], "doc_id long")).collect()), key=key)
    for a, b in zip(got, sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and (a[2:] == b[2:] if b[2] is None else a[2:] == pytest.approx(b[2:], rel=1e-9)), a
