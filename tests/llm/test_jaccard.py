import random
import re

import numpy as np
import pyarrow as pa
import pytest

from aerolith.llm import common, graph
from aerolith.llm import jaccard as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    rep = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        rep.setdefault(t or "", i)
    sets = {i: shingles(t) for t, i in rep.items()}
    links = {i: set() for i in sets}
    ids = list(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            n = len(sets[i] & sets[j])
            if n and 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
                links[i].add(j)
                links[j].add(i)
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in ids:
        for j in links[i]:
            a, b = sorted((find(i), find(j)))
            top[b] = a
    copies = {}
    for _, t in rows:
        copies[t or ""] = copies.get(t or "", 0) + 1
    return sorted((i, find(rep[t or ""]), len(links[rep[t or ""]]), copies[t or ""]) for i, t in rows)


def corpus(rng, families, per, words=120):
    rows = []
    for f in range(families):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(per):
            t = list(base)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(words)] = f"x{rng.randrange(99999)}"
            rows.append((len(rows), " ".join(t)))
    return rows


def test_shingle_hashes_stand_for_shingles():
    texts = ["a b c d e f", "a b", "", " \n", "b a", "a  b\tc d e f", "é ü ß x y", "a b c d e"]
    at = common.flat_bytes(pa.array([*texts, None]))
    h, s = common.shingle_hashes(*common.word_hashes(*at), 5)
    sets = [frozenset(h[s[k] : s[k + 1]].tolist()) for k in range(len(texts))]
    for a, x in zip(texts, sets, strict=True):
        for b, y in zip(texts, sets, strict=True):
            assert len(x & y) == len(shingles(a) & shingles(b)), (a, b)
    sliced = pa.array(texts).slice(2, 4)
    h2, s2 = common.shingle_hashes(*common.word_hashes(*common.flat_bytes(sliced)), 5)
    assert [frozenset(h2[s2[k] : s2[k + 1]].tolist()) for k in range(4)] == sets[2:6]


def test_bands_reach_the_recall():
    bands, rows = J.choose_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= J.RECALL and bands * rows <= J.MAX_HASHES
    assert J.choose_bands(0.5, 0.9, 32)[1] < rows


def test_signatures_estimate_similarity():
    rng = random.Random(2)
    a = [f"w{rng.randrange(9999)}" for _ in range(400)]
    b = a[:200] + [f"v{k}" for k in range(200)]
    _, h, low = J.signatures(pa.array([" ".join(a), " ".join(b), ""]), 100, 1)
    true = len(shingles(" ".join(a)) & shingles(" ".join(b))) / len(shingles(" ".join(a)) | shingles(" ".join(b)))
    assert abs((h[0] == h[1]).mean() - true) < 0.2 and abs((low[0] == low[1]).mean() - true) < 0.2


def test_agreement_asked_for_is_that_of_the_binomial_law():
    k = J.least_agreement(150, 0.8, 1e-3)
    rng = np.random.default_rng(1)
    drawn = rng.binomial(150, 0.8 + 0.2 / 256, 200_000)
    assert (drawn < k).mean() <= 1.2e-3 and (drawn < k + 2).mean() > 1e-3


def test_against_brute_force(docs, with_clashes):
    rng = random.Random(7)
    rows = corpus(rng, 12, 6) + [(900, None), (901, ""), (902, "one two"), (903, "one  two"), (904, "two one"), (905, " ")]
    rows += [(1000 + k, rows[0][1]) for k in range(5)]
    got = sorted(map(tuple, J.jaccard_classes(with_clashes(docs(*rows))).collect()))
    assert got == brute(rows)


def test_large_classes_in_blocks(docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 8)
    monkeypatch.setattr(J, "BUCKET", 5)
    rows = corpus(random.Random(11), 2, 45)
    assert sorted(map(tuple, J.jaccard_classes(docs(*rows)).collect())) == brute(rows)


def test_blocks_are_bounded_by_bytes(docs, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_BYTES", 5000)
    rows = corpus(random.Random(12), 2, 20)
    assert sorted(map(tuple, J.jaccard_classes(docs(*rows)).collect())) == brute(rows)


def test_long_texts_and_templates(docs):
    """Long texts are read whole; texts that share half of their words are in no class, however many there are."""
    rng = random.Random(13)
    long = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(["new", *long[1:]])), (3, " ".join([*long[:30_000], *long[:30_000]]))]
    template = [f"t{k}" for k in range(60)]
    rows += [(100 + k, " ".join([*template, *(f"own{k}_{j}" for j in range(60))])) for k in range(80)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.jaccard_classes(docs(*rows)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0), **{100 + k: (100 + k, 0) for k in range(80)}}


def test_block_pairs_are_whole():
    texts = pa.array(["a b c d e f g h i j k l m n o p q r s t"] * 3)
    own = J.linked(texts, np.array([0, 0, 1]), False)
    assert own.sum() == 6
    assert J.linked(texts, np.array([0, 0, 1]), True).sum() == 4


def test_keep_one(docs, with_clashes):
    rows = corpus(random.Random(3), 3, 4)
    df = with_clashes(docs(*rows))
    got = J.keep_one(df)
    want = {c for _, c, _, _ in brute(rows)}
    assert got.columns == df.columns and {r.doc_id for r in got.collect()} == want


def test_keep_one_of_repeated_and_missing_ids(docs):
    words = [f"w{k}" for k in range(200)]
    near = " ".join([*words[:100], "changed", *words[101:]])
    other = " ".join(f"v{k}" for k in range(200))
    rows = [(None, " ".join(words))] * 3 + [(None, near)] * 2 + [(5, other)] * 3 + [(6, other), (8, "x y z")]
    got = J.keep_one(docs(*rows)).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 5, 8]


def test_empty_and_nulls(docs):
    assert J.jaccard_classes(docs()).count() == 0 and J.keep_one(docs()).count() == 0
    got = J.jaccard_classes(docs((None, "a b c"), (None, None))).collect()
    assert [r.class_id for r in got] == [None, None]


@pytest.mark.parametrize("chain", [2, 37])
def test_components(spark, chain):
    rng = random.Random(chain)
    names = list(range(chain))
    rng.shuffle(names)
    edges = list(zip(names, names[1:], strict=False)) + [(1000, 1001), (1002, 1001), (5, 5)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(chain), 0), 1000: 1000, 1001: 1000, 1002: 1000}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_against_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    want = c.execute(J.OP7_SQL).fetchall()
    assert sorted(map(tuple, J.op7_jaccard(spark, "/root/testdata/sf0.001").select("doc_id", "class_id", "n_links", "n_copies").collect())) == sorted(want)
