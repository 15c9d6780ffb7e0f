"""Quality rules with adaptive thresholds, DataFrame operations only.

Every text is measured once. The measures of a language and source go into
log-linear histograms: mergeable quantile sketches of bounded size whose merge is
a sum, so partial sketches combine before the shuffle and give the same answer in
any order (relative error 1/32). Fences replace fixed cutoffs. They are measured on
the side that junk does not reach: the upper one is the median and ``FENCE`` times
what lies between the lower quartile and the median, the lower one the same with the
upper quartile. So junk that makes up a third of a group moves neither, while a fence
beyond the upper quartile would follow it. A group under ``MIN_GROUP`` documents is
filled up to that number with its language's sketch in proportion, and a small
language with that of all: one document more or less changes little. Documents meet
their group's fences in a join on language and source.

Defined results: null or empty text has no words and fails the base rules; texts of
any length are measured whole; null language or source is a group of its own;
repeated rows are rows; equal values lie in one bucket, on the inner side of a fence;
without documents the result is empty. Extra columns pass through; a column named
like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playerlake.llm.storage import saved

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 200
FENCE = 9

#: Measure, least distance of quartile and median, whether a low value fails too. Ratios are millionths.
MEASURES = [
    ("word_length", 125_000, True),
    ("symbols", 2_500, False),
    ("capitals", 10_000, False),
    ("marks", 2_500, False),
    ("dup_lines", 62_500, False),
    ("repeats", 50_000, False),
]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
COUNTS = [*BASE, "n_lines", "n_capitals", "n_marks"]


def _count_of(text: Column, others: str) -> Column:
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts and ``base_failed``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    taken = {c.lower() for c in [*COUNTS, "base_failed", "kept", "_words", "_lines", "_grams", "_repeated"]}
    df = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])
    df = df.withColumns({
        "_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        "_lines": F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)),
        "n_symbols": _count_of(text, r"[^#*$%&|<>]+"),
        "n_capitals": _count_of(text, r"[^\p{Lu}]+"),
        "n_marks": _count_of(text, r"[^!?]+"),
    })
    # three-word windows as hashes; their positions only where one repeats
    df = df.withColumn("_grams", F.expr(
        "if(size(_words) < 3, array(), transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])))"))
    df = df.withColumn("_repeated", F.expr(
        "if(size(array_distinct(_grams)) = size(_grams), array(), sort_array(transform(_grams, (h, i) -> struct(h as h, i as i))))"))
    df = df.withColumn("_repeated", F.expr(
        "transform(filter(_repeated, (x, k) -> x.h = get(_repeated, k - 1).h or x.h = get(_repeated, k + 1).h), x -> x.i)"))
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.expr("cast(size(array_distinct(flatten(transform(_repeated, i -> array(i, i + 1, i + 2))))) as bigint)"),
    }).drop("_words", "_lines", "_grams", "_repeated")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def _measures() -> dict[str, Column]:
    """Integer measures of a document that passed the base rules."""
    return {
        "word_length": F.expr("1000000 * word_chars div n_words"),
        "symbols": F.expr("1000000 * n_symbols div word_chars"),
        "capitals": F.expr("1000000 * n_capitals div word_chars"),
        "marks": F.expr("1000000 * n_marks div word_chars"),
        "dup_lines": F.expr("1000000 * n_dup_lines div n_lines"),
        "repeats": F.expr("1000000 * n_repeat_words div n_words"),
    }


def sketch(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, measure, bucket, n): log-linear histograms; summing n merges sketches."""
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), v.alias("value")) for name, v in _measures().items()]))
    rows = measured.where(~F.col("base_failed")).select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{source_col}`").alias("source"), values.alias("m"))
    shift = F.greatest(F.length(F.bin("m.value")) - 6, F.lit(0))
    bucket = 32 * shift + F.call_function("shiftright", F.col("m.value"), shift)
    return rows.select("lang", "source", "m.measure", bucket.cast("int").alias("bucket")).groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n"))


GROUP = ["level", "of_lang", "of_source", "measure"]


def _filled(small: DataFrame, large: DataFrame, same: Column) -> DataFrame:
    """Sketches of groups, those under ``MIN_GROUP`` filled up by the larger group's in proportion.

    Numbers of a filled sketch are scaled to stay whole: each document of the group
    counts as the larger group's total, and that group's documents share the rest.
    """
    enough = small.where(F.col("total") >= MIN_GROUP)
    few = small.where(F.col("total") < MIN_GROUP)
    other = large.select(F.col("of_lang").alias("in_lang"), F.col("measure").alias("in_measure"), F.col("bucket").alias("in_bucket"), F.col("n").alias("in_n"), F.col("total").alias("in_total"))
    totals = other.select("in_lang", "in_measure", "in_total").distinct()
    own = few.join(totals, same & (F.col("measure") == F.col("in_measure"))).select(*GROUP, "bucket", (F.col("n") * F.col("in_total")).alias("n"))
    rest = few.select(*GROUP, "total").distinct().join(other, same & (F.col("measure") == F.col("in_measure")))
    rest = rest.select(*GROUP, F.col("in_bucket").alias("bucket"), ((MIN_GROUP - F.col("total")) * F.col("in_n")).alias("n"))
    mixed = own.unionByName(rest).groupBy(*GROUP, "bucket").agg(F.sum("n").alias("n"))
    return enough.unionByName(mixed.withColumn("total", F.sum("n").over(Window.partitionBy(*GROUP))))


def fences(sketches: DataFrame) -> DataFrame:
    """(lang, source, measure, low, high) of every group of the sketches."""
    merged = (
        sketches.withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        .withColumn("of_lang", F.when(F.col("level") < 2, F.col("lang")))
        .withColumn("of_source", F.when(F.col("level") < 1, F.col("source")))
        .groupBy(*GROUP, "bucket")
        .agg(F.sum("n").alias("n"))
    )
    merged = saved(merged.withColumn("total", F.sum("n").over(Window.partitionBy(*GROUP))), "sketches")
    of_source, of_lang, of_all = [merged.where(F.col("level") == k) for k in range(3)]
    of_lang = _filled(of_lang, of_all, F.lit(True))
    filled = _filled(of_source, of_lang, F.col("of_lang").eqNullSafe(F.col("in_lang")))

    group = Window.partitionBy(*GROUP)
    ranked = filled.withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
    shift = F.greatest(F.expr("bucket div 32 - 1").cast("int"), F.lit(0))
    value = F.call_function("shiftleft", F.col("bucket").cast("long") - 32 * shift, shift)
    quartile = {f"q{q}": F.min(F.when(100 * F.col("upto") >= q * F.col("total"), value)) for q in (25, 50, 75)}
    stats = ranked.groupBy(*GROUP).agg(*[c.alias(k) for k, c in quartile.items()])
    least = F.coalesce(*[F.when(F.col("measure") == name, F.lit(spread)) for name, spread, _ in MEASURES])
    wide = lambda distance: FENCE * F.greatest(distance, F.expr("q50 div 16"), least)
    low_too = F.col("measure").isin([name for name, _, low in MEASURES if low])
    low = F.when(low_too, F.col("q50") - wide(F.col("q75") - F.col("q50")))
    high = F.col("q50") + wide(F.col("q50") - F.col("q25"))
    return stats.select(F.col("of_lang").alias("lang"), F.col("of_source").alias("source"), "measure", low.alias("low"), high.alias("high"))


def judge(measured: DataFrame, limits: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``measured`` with ``kept``: joined to the fences of its language and source.

    The fences are saved first: their size is then known when the join is planned,
    and few groups are broadcast instead of moving the texts.
    """
    row = limits.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(
        *[F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"_{name}_{side}") for name, _, _ in MEASURES for side in ("low", "high")])
    joined = measured.join(saved(row, "fences"), F.col(f"`{lang_col}`").eqNullSafe(F.col("_lang")) & F.col(f"`{source_col}`").eqNullSafe(F.col("_source")), "left")
    inside = F.lit(True)
    for name, value in _measures().items():
        inside = inside & (value >= F.coalesce(f"_{name}_low", value)) & (value <= F.coalesce(f"_{name}_high", value))
    kept = F.when(F.col("base_failed"), False).otherwise(inside)
    return joined.withColumn("kept", kept).select(*measured.columns, "kept")


def apply_rules(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or its ``columns``) with the counts, ``base_failed`` and ``kept``.

    The measured rows are written to the shared scratch folder, so each text is
    measured once for both the sketches and the filter.
    """
    measured = measure(docs, text_col)
    if columns is not None:
        measured = measured.select(*[F.col(f"`{c}`") for c in columns], *COUNTS, "base_failed")
    measured = saved(measured, "quality")
    return judge(measured, fences(sketch(measured, lang_col, source_col)), lang_col, source_col)
