import hashlib

import numpy as np

from aerolith.llm import exact_dedup as D


def test_perfect_hash_is_minimal_and_finds_its_own():
    for n in (0, 1, 2, 1000):
        digests = np.frombuffer(b"".join(hashlib.sha256(bytes([k % 256, k // 256])).digest() for k in range(n)), np.uint8).reshape(-1, 32)
        index = D.PerfectHash.build(digests)
        assert sorted(index.slots(digests)) == list(range(n))
        strangers = np.frombuffer(b"".join(hashlib.sha256(b"x%d" % k).digest() for k in range(50)), np.uint8).reshape(-1, 32)
        slots = index.slots(strangers)
        assert ((slots >= -1) & (slots < max(n, 1))).all()
        assert not any(s >= 0 and (digests[s] == x).all() for s, x in zip(slots, strangers, strict=True))


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        best = max((x for x in ids if x is not None), default=None)
        out.append((i, best, len(ids), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_brute_force(docs, with_clashes):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (None, "c"), (None, "c"), (None, "d"), (9, "d"), (10, "x" * 200_000), (11, "x" * 200_000), (12, "é")]
    rows += [(100 + k, "hot") for k in range(300)]
    got = D.exact_dedup(with_clashes(docs(*rows))).drop("historical")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_members_and_strangers_of_the_registry(docs, spark):
    history, new = D.digests(docs((1, "a"), (2, "a"), (3, "b"))), D.digests(docs((9, "a"), (4, "c"), (5, "c")))
    got = {(r.keep_id, r.group_size, r.historical) for r in D.groups(new, D.build_index(history, 2), 2).collect()}
    assert got == {(9, 3, True), (3, 1, True), (5, 2, False)}


def test_ids_beyond_floats_beside_null_ids(docs, spark):
    big = 1 << 60
    rows = [(big + k, f"t{k // 2}") for k in range(23)] + [(None, "none"), (None, None)]
    assert sorted(map(tuple, D.exact_dedup(docs(*rows)).drop("historical").collect()), key=repr) == brute(rows)
    assert sorted((r.doc_id for r in D.drop_copies(docs(*rows)).collect()), key=repr) == sorted([big + k for k in range(23) if k % 2 or k == 22] + [None, None], key=repr)
    new, none = D.digests(docs(*rows)), D.digests(docs())
    for history, arriving in ((none, new), (new, none), (new.filter("doc_id IS NULL"), new.filter("doc_id IS NOT NULL"))):
        got = {(r.keep_id, r.group_size) for r in D.groups(arriving, D.build_index(history, 3), 3).collect()}
        assert got == {(b, n) for _, b, n, _, _ in brute(rows)}


def test_shards_follow_both_sides(docs, monkeypatch):
    monkeypatch.setattr(D, "SHARD_DIGESTS", 2)
    rows = [(k, f"t{k // 3}") for k in range(40)]
    assert sorted(map(tuple, D.exact_dedup(docs(*rows)).drop("historical").collect()), key=repr) == brute(rows)


def test_empty(docs):
    assert D.exact_dedup(docs()).count() == 0 and D.drop_copies(docs()).count() == 0


def test_drop_copies_keeps_columns(docs, with_clashes):
    df = with_clashes(docs((1, "a"), (2, "a"), (3, "b"), (None, "c")))
    got = D.drop_copies(df)
    assert got.columns == df.columns and sorted((r.doc_id for r in got.collect()), key=repr) == [2, 3, None]


def test_drop_copies_keeps_one_row_of_repeated_ids(docs):
    rows = [(1, "a", "en", "s")] * 3 + [(None, "c")] * 4 + [(1, "d"), (2, "d"), (2, "d"), (7, "e"), (2, "a", "de", "x"), (2, "a", "fr", "y")]
    got = D.drop_copies(docs(*rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(2, "a"), (None, "c"), (2, "d"), (7, "e")], key=repr)
