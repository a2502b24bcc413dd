import random
import time

from pyspark.sql import functions as F

from aerolith.llm import packing as P


def slow(items, capacity):
    """The tightest compatible bin by looking at all of them."""
    order = sorted(items, key=lambda i: (i[0] is not None, i[0] or 0, i[2] is not None, i[2] or "", i[3] is not None, i[3] or 0))
    out, rest, bins = [], [], 0
    for d, n, s, c in order:
        full = (n - 1) // capacity if n else 0
        for k in range(full):
            out.append((d, k, k * capacity, capacity, bins, 0))
            bins += 1
        rest.append((d, full, full * capacity, n - full * capacity, s, c))
    open_ = {}
    for d, k, start, n, s, c in sorted(rest, key=lambda r: -r[3]):
        fits = [(capacity - b["used"], i) for i, b in open_.items() if b["used"] + n <= capacity and s not in b["sources"] and (c is None or c not in b["clusters"])]
        if fits:
            _, i = min(fits)
        else:
            i, bins = bins, bins + 1
            open_[i] = {"used": 0, "sources": set(), "clusters": set()}
        b = open_[i]
        out.append((d, k, start, n, i, b["used"]))
        b["used"] += n
        b["sources"].add(s)
        b["clusters"].add(c)
    return out


def test_against_brute_force():
    rng = random.Random(4)
    for _ in range(40):
        items = [(rng.choice([None, *range(30)]), rng.choice([0, 1, 7, 50, 64, 100, 101, 250, 300]), rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, 1, 2, 3])) for _ in range(rng.randrange(60))]
        assert P.pack(items, 100) == slow(items, 100)


def test_bins_hold_no_conflicts_and_lose_nothing(docs, with_clashes):
    rng = random.Random(8)
    texts = {k: "w " * rng.choice([0, 1, 30, 400, 900, 2048, 2049, 5000]) + (f"d{k % 40}" if k % 3 else "") for k in range(400)}
    source = {k: "hot" if k % 3 == 0 else f"s{k % 11}" for k in texts}
    df = with_clashes(docs(*[(k, texts[k], "en", source[k]) for k in texts]))
    rows = P.best_fit(df).collect()
    assert rows and [tuple(r) for r in sorted(rows)] == [tuple(r) for r in sorted(P.best_fit(df.repartition(3)).collect())]
    seen, bins = {}, {}
    for r in rows:
        seen.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.bin_id, []).append(r)
    for k, t in texts.items():
        parts = sorted(seen[k], key=lambda r: r.piece)
        assert sum(r.n_tokens for r in parts) == len(t.split()) and [r.piece for r in parts] == list(range(len(parts)))
        assert [r.start_token for r in parts] == [P.CAPACITY * r.piece for r in parts]
    for held in bins.values():
        held.sort(key=lambda r: (r.bin_offset, r.n_tokens))
        assert sum(r.n_tokens for r in held) <= P.CAPACITY
        assert len({source[r.doc_id] for r in held}) == len(held) == len({texts[r.doc_id] for r in held})


def test_nulls_repeats_and_empty(docs):
    df = docs((1, None, "en", None), (1, None, "en", None), (None, "a b", "en", "s"))
    rows = P.best_fit(df).collect()
    assert len(rows) == 3 and len({r.bin_id for r in rows if r.doc_id == 1}) == 2
    assert P.best_fit(docs()).count() == 0


def test_repeated_rows_are_spread_and_fast(spark, monkeypatch):
    """Copies of one row, and rows with neither id nor text: as many bins as rows, in shards of even size, in time that does not grow with the square."""
    monkeypatch.setattr(P, "SHARD_DOCS", 500)
    df = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit("s").alias("source"))
    df = df.unionAll(spark.range(3000).select(F.lit(7), F.lit("a b c"), F.lit("s"))).unionAll(spark.range(1000).select("id", F.concat(F.lit("x "), F.col("id").cast("string")), F.concat(F.lit("t"), F.col("id").cast("string"))))
    rows = P.best_fit(df).collect()
    assert len(rows) == 8000
    shards = {}
    for r in rows:
        shards.setdefault(r.bin_id >> 32, []).append(r)
    assert len(shards) == 16 and max(map(len, shards.values())) < 600
    assert len({r.bin_id for r in rows if r.doc_id is None}) == 4000 and len({r.bin_id for r in rows if r.doc_id == 7 and r.n_tokens == 3}) == 3000
    began = time.time()
    assert len({r[4] for r in P.pack([(None, 0, None, 5)] * 20_000, 2048)}) == 20_000 and time.time() - began < 10


def test_own_clusters_and_sizes(docs):
    df = docs(*[(k, "x", "en", f"s{k}") for k in range(4)])
    rows = P.best_fit(df, cluster=F.lit(None), size=F.lit(512)).collect()
    assert len({r.bin_id for r in rows}) == 1 and sum(r.n_tokens for r in rows) == 2048
    assert len({r.bin_id for r in P.best_fit(df, cluster=F.lit(1), size=F.lit(512)).collect()}) == 4


def test_words_are_counted_as_they_stand(docs):
    df = docs((1, " a\tb\n\x0bc\xa0d "), (2, ""))
    assert [r.n for r in df.orderBy("doc_id").select(P.n_words(F.col("text")).alias("n")).collect()] == [3, 0]
