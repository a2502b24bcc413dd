import random

import corpus_pipeline
from aerolith.llm import registry


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11)) and set(registry.SQL) <= set(registry.QUERIES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "secret scans", "best-fit packing"]


def text(rng, n=120):
    return " ".join(f"{rng.choice(['alpha', 'beta', 'gamma', 'delta'])}{rng.randrange(9999)}" for _ in range(n))


def test_every_stage_takes_effect(spark, docs, tmp_path):
    rng = random.Random(6)
    rows = [(k, text(rng), "en", f"s{k % 5}") for k in range(120)]
    near = rows[0][1].split()
    near[60] = "changed"
    rows += [(200, rows[1][1], "en", "s9"), (201, " ".join(near), "en", "s8"), (202, "short text", "en", "s0"), (203, "### %%% " * 60 + text(rng), "en", "s1"), (204, text(rng) + " password=hunter22", "en", "s2"), (205, None, None, None)]
    docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    df = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, df, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        assert out.columns == df.columns
        kept.append({r.doc_id for r in out.select("doc_id").collect()})
        df = out
    everything = {r[0] for r in rows}
    assert kept[0] == everything - {202, 203, 205}
    assert kept[1] == kept[0] - {1}
    assert kept[2] == kept[1] - {201}
    assert kept[3] == kept[2]
    assert df.filter("doc_id = 204").first().text.endswith("password=[SECRET]")
    packed = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == kept[3]
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, packed))


def test_empty(spark, docs, tmp_path):
    docs().write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
