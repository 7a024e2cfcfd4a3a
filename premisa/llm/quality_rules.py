"""Rule-based quality filter whose cutoffs adapt to each language and source.

Every document gets integer features (thousandths). Their distributions are held in quantile sketches: counts of
log-linear buckets (32 steps per power of two), which merge by adding counts, whatever the partitioning. One grouped
aggregate builds the sketches of all (language, source) pairs at once; the sketches of small pairs are merged into that
of their language, and of small languages into that of the corpus. A cutoff is a robust upper (or lower) fence read off
the sketch: quartile plus three times the larger of the quartile distance and the rule's tolerance. Documents are then
joined with the cutoffs of their pair.

Defined cases: a null or empty text has no words and fails the base rules; null languages and sources are groups of
their own; repeated rows are judged alike and all counted; an empty table gives an empty result; other columns, also with
names used here, pass through ``accepted`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from premisa.llm.common import WORD_BREAK, packed, unpacked, words, written

#: Documents a pair needs before its own sketch decides.
LEAST_DOCUMENTS = 100
#: Rows of cutoffs that may be broadcast (about 100 bytes each); beyond it the join is salted.
BROADCAST_CUTOFFS = 100_000
SALTS = 32

# Feature, fence side (+1 upper, -1 lower), tolerance in the feature's unit (thousandths).
RULES = (
    ("symbols", 1, 30),
    ("word_length", 1, 1000),
    ("word_length", -1, 1000),
    ("dup_lines", 1, 150),
    ("repeats", 1, 150),
    ("capitals", 1, 80),
    ("shouts", 1, 30),
)
FEATURES = ("symbols", "word_length", "dup_lines", "repeats", "capitals", "shouts")
SYMBOLS = "#*$%&|<>"


def _repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Window hashes, with the window's place in their low bits, are sorted; equal neighbours are suspects. Only suspects
    (few in ordinary prose) are then compared as texts, in the same way, and the gaps between the places added up.
    """
    size = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(w).cast("long"))))
    return _let(size - 1, lambda low: _let(F.lit((1 << 63) - 1) - low, lambda high: _repeated_within(w, low, high)))


def _repeated_within(w: Column, low: Column, high: Column) -> Column:
    """``low`` masks enough bits for any place, ``high`` the others but the sign."""
    tagged = F.transform(
        F.when(F.size(w) >= 3, F.slice(w, 1, F.size(w) - 2)).otherwise(F.array().cast("array<string>")),
        lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]).bitwiseAND(high) + i,
    )

    def suspects(s: Column) -> Column:
        same = F.filter(s, lambda x, i: (x - F.get(s, i - 1) <= low) | (F.get(s, i + 1) - x <= low))
        return F.transform(same, lambda x: _let(x.bitwiseAND(low).cast("int"), lambda p: F.struct(
            F.concat_ws(" ", w[p], w[p + 1], w[p + 2]).alias("g"), p.alias("p"))))

    def found(s: Column) -> Column:
        same = F.filter(s, lambda x, i: (F.get(s, i - 1)["g"] == x["g"]) | (F.get(s, i + 1)["g"] == x["g"]))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.lit(3), x - F.coalesce(F.get(p, i - 1), x - 3)))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    exact = lambda s: _let(F.sort_array(suspects(s)), lambda x: _let(found(x), covered))
    return _let(F.sort_array(tagged), exact).cast("long")


def _let(value: Column, use) -> Column:
    """Bind ``value`` once: a lambda variable is computed once, a repeated expression may not be."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _occurrences(t: Column, characters: str) -> Column:
    """How often the given ASCII characters occur."""
    each = [F.octet_length(t) - F.octet_length(F.replace(t, F.lit(c), F.lit(""))) for c in characters]
    return sum(each[1:], each[0]).cast("long")


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row), the counts of the base rules, and the features in thousandths."""
    t = F.coalesce(F.col(f"row.{text}").cast("string"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = packed(docs).withColumn("words", _let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), F.length(F.array_join(w, "")).cast("long").alias("chars"),
        _repeated_words(w).alias("repeated"))))
    df = df.withColumn("lines", _let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))))
    df = df.select(
        "row",
        F.col("words.n").alias("n_words"),
        F.col("words.chars").alias("word_chars"),
        _occurrences(t, SYMBOLS).alias("n_symbols"),
        F.col("lines.dup").alias("n_dup_lines"),
        F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.n").alias("n_lines"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        _occurrences(t, "!?").alias("n_shouts"),
    )
    share = lambda a, b: F.expr(f"{a} * 1000 div greatest({b}, 1)")
    return df.select(
        *df.columns,
        F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
        share("n_symbols", "n_words").alias("symbols"),
        share("word_chars", "n_words").alias("word_length"),
        share("n_dup_lines", "n_lines").alias("dup_lines"),
        share("n_repeat_words", "n_words").alias("repeats"),
        share("n_capitals", "word_chars").alias("capitals"),
        share("n_shouts", "n_words").alias("shouts"),
    )


def bucket(v: str) -> str:
    """Sketch bucket of a non-negative whole number: exact below 64, then 32 buckets per power of two."""
    e = f"(length(bin({v})) - 6)"
    return f"if({v} < 64, {v}, 32 * {e} + ({v} div cast(power(2, {e}) as bigint)))"


def bucket_value(b: str) -> str:
    """The smallest value of a bucket."""
    e = f"({b} div 32 - 1)"
    return f"if({b} < 64, {b}, (32 + {b} % 32) * cast(power(2, {e}) as bigint))"


def cutoffs(features: DataFrame) -> DataFrame:
    """One row per (lang, source): the fences of every rule. ``features``: lang, source and FEATURES of judged rows."""
    spark = features.sparkSession
    pairs = ", ".join(f"'{f}', {bucket(f)}" for f in FEATURES)
    long = features.select("lang", "source", F.expr(f"stack({len(FEATURES)}, {pairs}) as (feature, b)"))
    # a (language, source) sketch: one row per feature and bucket in use, summed before the shuffle
    sketch = written(long.groupBy("lang", "source", "feature", "b").agg(F.count("*").alias("n")), "sketches")
    totals = sketch.where("feature = 'symbols'").groupBy("lang", "source").agg(F.sum("n").alias("docs"))
    langs = totals.groupBy(F.col("lang").alias("l")).agg(F.sum("docs").alias("lang_docs"))
    # the level that decides: 0 the pair, 1 its language, 2 the corpus
    level = totals.join(langs, F.col("lang").eqNullSafe(F.col("l")), "left").select(
        "lang", "source",
        F.expr(f"case when docs >= {LEAST_DOCUMENTS} then 0 when lang_docs >= {LEAST_DOCUMENTS} then 1 else 2 end").alias("level"),
    )
    merged = (
        sketch.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("level"))
        .select(
            "level", "feature", "b", "n",
            F.expr("if(level < 2, lang, null)").alias("lang"),
            F.expr("if(level < 1, source, null)").alias("source"),
        )
        .groupBy("level", "lang", "source", "feature", "b").agg(F.sum("n").alias("n"))
    )
    by = Window.partitionBy("level", "lang", "source", "feature")
    ranked = merged.select(
        "*", F.sum("n").over(by.orderBy("b")).alias("upto"), F.sum("n").over(by).alias("total"),
        F.expr(bucket_value("b")).alias("value"),
    )
    at = lambda k: F.min(F.when(F.expr(f"upto * 4 >= total * {k}"), F.col("value")))
    quartiles = ranked.groupBy("level", "lang", "source", "feature").agg(at(1).alias("q1"), at(3).alias("q3"))
    fences = []
    for k, (f, side, least) in enumerate(RULES):
        edge = f"q3 + 3 * greatest(q3 - q1, {least})" if side > 0 else f"q1 - 3 * greatest(q3 - q1, {least})"
        fences.append(F.max(F.when(F.col("feature") == f, F.expr(edge))).alias(f"cut{k}"))
    found = quartiles.groupBy("level", "lang", "source").agg(*fences)
    found = found.select(F.col("level").alias("at"), F.col("lang").alias("l"), F.col("source").alias("s"),
                         *[f"cut{k}" for k in range(len(RULES))])
    use = level.select(
        "lang", "source", "level", F.expr("if(level < 2, lang, null)").alias("ul"),
        F.expr("if(level < 1, source, null)").alias("us"),
    )
    same = (use["level"] == found["at"]) & use["ul"].eqNullSafe(found["l"]) & use["us"].eqNullSafe(found["s"])
    cuts = use.join(found, same).select("lang", "source", *[f"cut{k}" for k in range(len(RULES))])
    return written(cuts, "cutoffs") if spark else cuts


def verdict() -> Column:
    """Kept: passes the base rules and every fence of its group."""
    tests = [
        F.expr(f"{f} <= cut{k}" if side > 0 else f"{f} >= cut{k}") for k, (f, side, _) in enumerate(RULES)
    ]
    passed = ~F.col("base_failed")
    for test in tests:
        passed = passed & F.coalesce(test, F.lit(True))
    return passed


def joined(df: DataFrame, cuts: DataFrame, lang: Column, source: Column) -> DataFrame:
    """``df`` with the cutoffs of its group. The cutoffs are counted first: few are broadcast, else hot groups are salted."""
    cuts = cuts.withColumnsRenamed({"lang": "_l", "source": "_s"})
    same = lang.eqNullSafe(F.col("_l")) & source.eqNullSafe(F.col("_s"))
    if cuts.count() <= BROADCAST_CUTOFFS:
        return df.join(F.broadcast(cuts), same, "left").drop("_l", "_s")
    salted = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = df.withColumn("_deal", F.expr(f"cast(rand(17) * {SALTS} as int)"))
    same = same & (F.col("_deal") == F.col("_salt"))
    return dealt.join(salted, same, "left").drop("_l", "_s", "_salt", "_deal")


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept."""
    counts = counted(docs).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.lang").alias("lang"), F.col("row.source").alias("source"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *FEATURES,
    )
    counts = written(counts, "quality")
    cuts = cutoffs(counts.where("not base_failed"))
    found = joined(counts, cuts, F.col("lang"), F.col("source"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        verdict().alias("kept"),
    )


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns they came with. The table is stored once with counts."""
    counts = written(counted(docs).where("not base_failed"), "quality")
    cuts = cutoffs(counts.select(F.col("row.lang").alias("lang"), F.col("row.source").alias("source"), *FEATURES))
    found = joined(counts, cuts, F.col("row.lang"), F.col("row.source"))
    return unpacked(found.where(verdict()))
