"""Quality rules with thresholds that adapt to each language and source. Built of DataFrame functions only.

Each text is measured; a mergeable quantile sketch per (lang, source) holds the distribution of each measure, and thresholds
drawn from the sketches replace fixed cutoffs. The sketch is a logarithmic histogram: a value's bucket keeps its 8
leading binary digits, so that a quantile is off by less than 1/128 of its value. Buckets are counted, and counts add up
in any order: the sketch is the result of one aggregation with map-side partial sums, the same on every run.

A measure is counted in thousandths of the words, the first FREE occurrences apart, which in a short text say nothing. Its upper threshold is the group's
median, a fence above it and a MARGIN: the fence is FENCE times the distance to the 90th percentile, but no more than what less than half of a group cannot
move, FENCE times the distance to the 10th percentile or, if that is more, the median itself. So junk in up to half of a group does not loosen the group's own threshold, and
a group in which nothing stands out loses nothing, however many rows it has. Word length is held from both sides likewise, with an allowance NOISE / sqrt(words) for the chance in a short text's mean, and upwards one token of LONG_TOKEN characters. No threshold is
a fixed cutoff: all follow the group's quantiles; the margins, far below any cutoff in use, are what two texts of one kind may differ by. A
group of fewer than MIN_GROUP rows takes the quantiles of its language, and a language of fewer those of all rows.

Scale: texts are not shuffled, and measured once: the measures are written to the shared folder (op10: they alone, some 60 bytes a row; the pipeline's stage: with the rows, as Parquet),
and both the sketches and the verdicts read them there. Sketches shuffle (group, bucket, count) rows only; a hot source arrives as one row per bucket and task. The thresholds
have a row for each (lang, source); they are broadcast if there are at most MAX_BROADCAST_GROUPS of them (counted first), else joined
by shuffling the thresholds and the rows, whose hot keys adaptive execution splits.

Defined cases: a null text has no words and fails the base rules, as has an empty one. A null lang or source counts as the empty one, and both are one
group. Repeated rows are measured and kept or dropped alike, and count each. Other columns pass through
untouched, also where their names are those of the measures. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh, table, text_of, written

FENCE = 6
MIN_GROUP = 100
MAX_BROADCAST_GROUPS = 100_000
#: Measure: (numerator, occurrences that are free, margin above the fence in thousandths of the words); word length is held from both sides.
UPPER = {"symbols": ("n_symbols", 3, 20), "dup_lines": ("n_dup_lines", 2, 10), "repeats": ("n_repeat_words", 10, 150), "length": ("word_chars", 0, 500)}
LOWER = {"length": 500}
#: Thousandths of a character by which the mean word length of a text may be off, times the root of its words.
NOISE = 8000
#: Characters of one long token, an address or a digest, that count for nothing upwards.
LONG_TOKEN = 40
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def bucket(x: Column) -> Column:
    """x without what its 8 leading binary digits do not hold."""
    shift = F.greatest(F.length(F.bin(x)) - 8, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", x, shift), shift)


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column) -> Column:
    """How many words lie in 5-word windows, given by their 64-bit hashes, that occur twice or more.

    Windows are sorted by (hash, place); places whose neighbour has the same hash are repeated. Their sorted places are run through once, each adding the words that the one before did not cover.
    """

    def repeated(pairs: Column) -> Column:
        twin = lambda p, k: (p["h"] == F.get(pairs, k - 1)["h"]) | (p["h"] == F.get(pairs, k + 1)["h"])
        return F.aggregate(
            F.array_sort(F.transform(F.filter(pairs, twin), lambda p: p["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(-5).alias("at")),
            lambda a, i: F.struct((a["n"] + F.least(F.lit(5), i - a["at"])).alias("n"), i.alias("at")),
            lambda a: a["n"],
        )

    return let(F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), repeated)


def _words_and_repeats(text: Column) -> Column:
    """struct(n_words, n_repeat_words)."""

    def of_hashes(at: Column) -> Column:
        n = F.size(at)
        windows = F.transform(F.slice(at, 1, F.greatest(n - 4, F.lit(0))), lambda h, i: F.xxhash64(h, F.get(at, i + 1), F.get(at, i + 2), F.get(at, i + 3), F.get(at, i + 4)))
        repeats = let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)))
        return F.struct(n.cast("long").alias("n_words"), repeats.cast("long").alias("n_repeat_words"))

    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def measured(docs: DataFrame, text: str, names: dict[str, str]) -> DataFrame:
    """docs with the measures under names[measure]."""
    (own,) = fresh(docs, "q_words")
    whole = text_of(text)
    out = docs.withColumns(
        {
            own: _words_and_repeats(whole),
            names["word_chars"]: F.length(F.regexp_replace(whole, r"[\x20\x09-\x0D]+", "")).cast("long"),
            names["n_symbols"]: F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long"),
            names["n_dup_lines"]: _duplicate_lines(whole),
        }
    )
    return out.withColumns({names["n_words"]: F.col(own)["n_words"], names["n_repeat_words"]: F.col(own)["n_repeat_words"]}).drop(own)


def _rates(names: dict[str, str]) -> dict[str, Column]:
    """Thousandths of the words, as whole numbers."""
    per = F.greatest(F.col(names["n_words"]), F.lit(1))
    return {k: F.floor(F.greatest(F.col(names[numerator]) - free, F.lit(0)) * 1000 / per).cast("long") for k, (numerator, free, _) in UPPER.items()}


def base_failed(names: dict[str, str]) -> Column:
    return (F.col(names["n_words"]) < 10) | (100 * F.col(names["n_repeat_words"]) > 20 * F.col(names["n_words"]))


def sketch(rows: DataFrame, names: dict[str, str], lang: str, source: str) -> DataFrame:
    """(lang, source, kind, bucket, n) over rows that pass the base rules: the mergeable sketch of every group."""
    rates = F.array(*[F.struct(F.lit(k).alias("kind"), bucket(v).alias("bucket")) for k, v in _rates(names).items()])
    flat = rows.filter(~base_failed(names)).select(F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(source), F.lit("")).alias("source"), F.inline(rates))
    return flat.groupBy("lang", "source", "kind", "bucket").agg(F.count(F.lit(1)).alias("n"))


def _quantiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Low (10th), middle and high (90th) bucket of each kind and group, from merged sketches. A group's buckets, at most some thousands, are sorted in one array."""
    merged = sketches.groupBy(*keys, "kind", "bucket").agg(F.sum("n").alias("n"))
    lists = merged.groupBy(*keys, "kind").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("b"), F.sum("n").alias("n"))

    def reach(q: int) -> Column:
        need = F.floor((F.col("n") * q + 99) / 100)
        return F.aggregate(
            "b",
            F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("at")),
            lambda a, x: F.struct((a["sum"] + x["n"]).alias("sum"), F.when(a["sum"] >= need, a["at"]).otherwise(x["bucket"]).alias("at")),
            lambda a: a["at"],
        )

    return lists.select(*keys, "kind", "n", reach(10).alias("lo"), reach(50).alias("mid"), reach(90).alias("hi"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """(lang, source, max_<kind>.., min_length): one row per group of the sketches."""
    own = _quantiles(sketches, ["lang", "source"])
    by_lang = _quantiles(sketches, ["lang"]).select("lang", "kind", *[F.col(c).alias(f"l_{c}") for c in ("n", "lo", "mid", "hi")])
    of_all = _quantiles(sketches, []).select("kind", *[F.col(c).alias(f"a_{c}") for c in ("n", "lo", "mid", "hi")])
    rows = own.join(by_lang, ["lang", "kind"], "left").join(F.broadcast(of_all), "kind", "left")  # of_all: a row per kind
    for c in ("lo", "mid", "hi"):
        rows = rows.withColumn(f"use_{c}", F.when(F.col("n") >= MIN_GROUP, F.col(c)).when(F.col("l_n") >= MIN_GROUP, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}")))
    mid, above, below = F.col("use_mid"), FENCE * (F.col("use_hi") - F.col("use_mid")), FENCE * (F.col("use_mid") - F.col("use_lo"))
    upper, lower = mid + F.least(above, F.greatest(below, mid)), mid - F.least(below, F.greatest(above, F.floor(mid / 2)))
    aggs = [F.max(F.when(F.col("kind") == k, upper + margin)).alias(f"max_{k}") for k, (_, _, margin) in UPPER.items()]
    aggs += [F.max(F.when(F.col("kind") == k, lower - margin)).alias(f"min_{k}") for k, margin in LOWER.items()]
    return rows.groupBy("lang", "source").agg(*aggs)


def judged(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", prefix: str = "", with_text: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """docs, without the text if so wished, with the measures, base_failed and kept, under names that prefix makes free; and those names."""
    wanted = [*MEASURES, "base_failed", "kept"]
    names = dict(zip(wanted, fresh(docs, *[f"{prefix}{x}" for x in wanted]), strict=True))
    rows = measured(docs, text, names)
    rows = written(rows, "measured") if with_text else cut(rows.drop(text))
    limits = cut(thresholds(sketch(rows, names, lang, source)))
    g_lang, g_source = fresh(rows, "g_lang", "g_source")
    cols = {c: n for c, n in zip([c for c in limits.columns if c not in ("lang", "source")], fresh(rows, *[c for c in limits.columns if c not in ("lang", "source")]), strict=True)}
    limits_named = limits.select(F.col("lang").alias(g_lang), F.col("source").alias(g_source), *[F.col(c).alias(n) for c, n in cols.items()])
    if limits.count() <= MAX_BROADCAST_GROUPS:
        limits_named = F.broadcast(limits_named)
    rates = _rates(names)
    fits = F.lit(True)
    noise = F.floor(NOISE / F.sqrt(F.greatest(F.col(names["n_words"]), F.lit(1)))).cast("long")
    for k in UPPER:
        at = F.greatest(rates[k] - noise - F.floor(LONG_TOKEN * 1000 / F.greatest(F.col(names["n_words"]), F.lit(1))), F.lit(0)).cast("long") if k in LOWER else rates[k]
        fits &= F.coalesce(bucket(at) <= F.col(cols[f"max_{k}"]), F.lit(True))  # by bucket, as thresholds come from buckets
    for k in LOWER:
        fits &= F.coalesce(rates[k] + noise >= F.col(cols[f"min_{k}"]), F.lit(True))
    out = rows.withColumn(names["base_failed"], base_failed(names))
    out = out.join(limits_named, (F.coalesce(out[lang], F.lit("")) == F.col(g_lang)) & (F.coalesce(out[source], F.lit("")) == F.col(g_source)), "left")
    out = out.withColumn(names["kept"], F.when(F.col(names["base_failed"]), F.lit(False)).otherwise(fits))
    return out.drop(g_lang, g_source, *cols.values()), names


def drop_low_quality(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """docs without the rows that the rules reject; same columns."""
    out, names = judged(docs, text, lang, source)
    return out.filter(F.col(names["kept"])).select(*docs.columns)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out, names = judged(docs, with_text=False)
    return out.select("doc_id", *[F.col(n).alias(x) for x, n in names.items()])


def _op10_sql() -> str:
    """The same in SQL, with thresholds from the same sketch."""
    rate = {k: f"CAST(floor(CAST(greatest({num} - {free}, 0) AS DOUBLE) * 1000 / greatest(n_words, 1)) AS BIGINT)" for k, (num, free, _) in UPPER.items()}
    union = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS kind, {v} AS v FROM passed" for k, v in rate.items())

    def quantile(keys: str, name: str) -> str:
        by = f"{keys}, kind" if keys else "kind"
        reach = lambda q: f"min(bucket) FILTER (WHERE upto >= floor((total * {q} + 99) / 100))"
        return f"""{name} AS (SELECT {by}, any_value(total) AS n, {reach(10)} AS lo, {reach(50)} AS mid, {reach(90)} AS hi FROM (
            SELECT *, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {by}) AS total FROM (SELECT {by}, bucket, sum(n) AS n FROM sk GROUP BY {by}, bucket)) GROUP BY {by})"""

    pick = ", ".join(f"CASE WHEN o.n >= {MIN_GROUP} THEN o.{c} WHEN l.n >= {MIN_GROUP} THEN l.{c} ELSE a.{c} END AS {c}" for c in ("lo", "mid", "hi"))
    above, below = f"{FENCE} * (hi - mid)", f"{FENCE} * (mid - lo)"
    upper, lower = f"mid + least({above}, greatest({below}, mid))", f"mid - least({below}, greatest({above}, mid // 2))"
    limits = ", ".join([f"max(CASE WHEN kind = '{k}' THEN {upper} + {margin} END) AS max_{k}" for k, (_, _, margin) in UPPER.items()] + [f"max(CASE WHEN kind = '{k}' THEN {lower} - {margin} END) AS min_{k}" for k, margin in LOWER.items()])
    noise = f"CAST(floor({NOISE} / sqrt(greatest(n_words, 1))) AS BIGINT)"
    low = lambda v: f"((({v}) >> greatest(length(bin({v})) - 8, 0)) << greatest(length(bin({v})) - 8, 0))"
    at = {k: f"greatest({rate[k]} - {noise} - {LONG_TOKEN * 1000} // greatest(n_words, 1), 0)" if k in LOWER else rate[k] for k in UPPER}
    fits = " AND ".join([f"coalesce({low(at[k])} <= max_{k}, true)" for k in UPPER] + [f"coalesce({rate[k]} + {noise} >= min_{k}, true)" for k in LOWER])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
t AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT rid, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g FROM t WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win WHERE g IS NOT NULL) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM rep, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT d.rid, doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
      coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d JOIN w USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
passed AS (SELECT * FROM b WHERE NOT base_failed),
v AS ({union}),
sk AS (SELECT lang, source, kind, (v >> greatest(length(bin(v)) - 8, 0)) << greatest(length(bin(v)) - 8, 0) AS bucket, count(*) AS n FROM v GROUP BY ALL),
{quantile("lang, source", "o")}, {quantile("lang", "l")}, {quantile("", "a")},
lim AS (SELECT lang, source, {limits} FROM (SELECT o.lang, o.source, o.kind, {pick} FROM o LEFT JOIN l ON o.lang = l.lang AND o.kind = l.kind LEFT JOIN a ON o.kind = a.kind) GROUP BY lang, source)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       base_failed, NOT base_failed AND {fits} AS kept FROM b LEFT JOIN lim USING (lang, source)
"""


OP10_SQL = _op10_sql()
