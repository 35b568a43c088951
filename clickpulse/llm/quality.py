"""Quality rules with risk-controlled cutoffs, in DataFrame functions only.

Method: each rule has a ladder of cutoffs from lenient to strict. Documents
labelled good are the holdout. For each stratum and rule, the exact binomial
test asks, cutoff by cutoff from the lenient end, whether the rule's rate of
rejecting good documents is below ``max_false_rejection / rules``; the first
cutoff that is not shown to be ends the walk (fixed-sequence testing, which
keeps the error of the whole walk at the level of one test). That level is
``error / (strata * rules)`` (Bonferroni). So with probability ``1 - error`` at
least, no stratum's rules together reject more than ``max_false_rejection`` of
its good documents. A stratum with too few labels to show anything keeps all.

Strata are languages (primary subtag, lower-cased), and ``other`` for documents
without a readable one. They are rows of the table of cutoffs: those that have
a good document that the base rule keeps, and in any case ``other``; their counted
number is that of the correction. A language without any label has no cutoffs
and keeps all. Null text counts as empty: no words, rejected by the base rule.
A document labelled more than once is good
if any of its labels says so; null labels say nothing. Repeated rows are judged
alike. Without labels only the base rule rejects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import staged
from clickpulse.plans.tuning import broadcast_if_small

SPACE = r"[\x20\x09-\x0D]+"
TRIM = " \t\n\x0b\f\r"
MAX_FALSE_REJECTION = 0.02
ERROR = 0.05
LEVELS = 20
#: rule -> (most lenient cutoff, strictest cutoff) of its measure; a document fails above the cutoff
RULES = {
    "symbols_per_word": (2.0, 0.2),
    "upper_case_share": (0.8, 0.25),
    "repeated_words_share": (0.5, 0.2),
    "repeated_lines_share": (0.9, 0.3),
    "mean_word_length": (20.0, 10.0),
}
MIN_WORDS = 50


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column, n: Column) -> Column:
    """Words lying in three-word windows that stand twice or more in ``words``."""
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            near = lambda e, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, lambda e, j: near(e, j - 1) | near(e, j + 1)), lambda e: e["i"]))

        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(_bind(placed, twice), start, step, lambda a: a["n"])

    return F.coalesce(_bind(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0)), F.lit(0))


def measures(text: Column) -> Column:
    """Struct of a text's counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper."""

    def counts(t: Column) -> Column:
        trimmed = F.btrim(t, F.lit(TRIM))
        words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
        lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(TRIM))) > 0)
        of_words = _bind(words, lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w, F.size(w)).alias("rep")))
        of_lines = _bind(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
        return F.struct(
            of_words.alias("w"),
            of_lines.alias("l"),
            F.length(F.regexp_replace(t, SPACE, "")).alias("word_chars"),
            F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).alias("n_symbols"),
            F.length(F.regexp_replace(t, "[^A-Z]+", "")).alias("n_upper"),
        )

    made = _bind(F.coalesce(text, F.lit("")), counts)
    return _bind(
        made,
        lambda m: F.struct(
            m["w"]["n"].cast("long").alias("n_words"),
            m["word_chars"].cast("long").alias("word_chars"),
            m["n_symbols"].cast("long").alias("n_symbols"),
            m["l"]["dup"].cast("long").alias("n_dup_lines"),
            m["w"]["rep"].cast("long").alias("n_repeat_words"),
            m["l"]["n"].cast("long").alias("n_lines"),
            m["n_upper"].cast("long").alias("n_upper"),
        ),
    )


def rule_measures(m: Column) -> dict[str, Column]:
    words, per = F.greatest(m["n_words"], F.lit(1)), F.greatest(m["word_chars"], F.lit(1))
    return {
        "symbols_per_word": m["n_symbols"] / words,
        "upper_case_share": m["n_upper"] / per,
        "repeated_words_share": m["n_repeat_words"] / words,
        "repeated_lines_share": m["n_dup_lines"] / F.greatest(m["n_lines"], F.lit(1)),
        "mean_word_length": m["word_chars"] / words,
    }


def rule_levels(m: Column) -> list[Column]:
    """For each rule the first level of its ladder that rejects; LEVELS if none does."""
    out = []
    for name, value in rule_measures(m).items():
        lenient, strict = RULES[name]
        # level j's cutoff is lenient - j * step, and what lies above it is rejected
        first = F.floor((F.lit(lenient) - value) / F.lit((lenient - strict) / (LEVELS - 1))) + 1
        out.append(F.least(F.greatest(first, F.lit(0)), F.lit(LEVELS)).cast("int"))
    return out


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), summed term by term in logarithms; 1 where k > n * p."""
    ratio = math.log(p) - math.log1p(-p)
    zero = F.struct((n * F.lit(math.log1p(-p))).alias("term"), (n * F.lit(math.log1p(-p))).alias("total"))

    def step(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + F.lit(ratio)
        high = F.greatest(a["total"], term)
        total = high + F.log1p(F.exp(-F.abs(a["total"] - term)))
        return F.struct(term.alias("term"), total.alias("total"))

    tail = F.exp(F.aggregate(F.sequence(F.lit(1).cast("long"), k), zero, step, lambda a: a["total"]))
    none = F.exp(n * F.lit(math.log1p(-p)))
    return F.when(k > n * F.lit(p), F.lit(1.0)).when(k == 0, none).otherwise(F.least(tail, F.lit(1.0)))


def stratum(lang: Column) -> Column:
    primary = F.lower(F.regexp_extract(F.trim(lang), "^([A-Za-z]{2,8})(?:[-_]|$)", 1))
    return F.when(primary != "", primary).otherwise(F.lit("other"))


def cutoffs(held_out: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """One row a stratum: ``cut``, for each rule the strictest level shown to be safe (-1: none).

    ``held_out``: stratum, levels (array<int>, one for each rule), of good documents.
    """
    spark = held_out.sparkSession
    rules = len(RULES)
    share = max_false_rejection / rules
    found = held_out.select("stratum", F.posexplode("levels").alias("rule", "level")).groupBy("stratum", "rule", "level").agg(F.count(F.lit(1)).alias("n"))
    found = staged(found, "levels")  # a row for each stratum, rule and level at most
    strata = found.select("stratum").union(spark.range(1).select(F.lit("other"))).distinct()
    level = error / (rules * strata.count())
    steps = spark.range(rules * (LEVELS + 1)).select((F.col("id") % rules).cast("int").alias("rule"), F.floor(F.col("id") / rules).cast("int").alias("level"))
    each = strata.crossJoin(F.broadcast(steps))  # a fixed number of steps
    counts = each.join(found, ["stratum", "rule", "level"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    walk = Window.partitionBy("stratum", "rule").orderBy("level").rowsBetween(Window.unboundedPreceding, 0)
    all_rows = Window.partitionBy("stratum", "rule")
    tried = counts.select("stratum", "rule", "level", F.sum("n").over(walk).alias("k"), F.sum("n").over(all_rows).alias("total")).where(F.col("level") < LEVELS)
    safe = tried.withColumn("safe", (F.col("total") > 0) & (binomial_tail(F.col("k"), F.col("total"), share) <= level))
    reached = safe.withColumn("so_far", F.min(F.col("safe").cast("int")).over(walk))
    best = reached.groupBy("stratum", "rule").agg(F.max(F.when(F.col("so_far") == 1, F.col("level")).otherwise(-1)).alias("cut"))
    return best.groupBy("stratum").agg(F.transform(F.sort_array(F.collect_list(F.struct("rule", "cut"))), lambda x: x["cut"]).alias("cut"))


def judge(docs: DataFrame, labels: DataFrame, max_false_rejection: float = MAX_FALSE_REJECTION, error: float = ERROR, carry: list[str] | None = None) -> DataFrame:
    """Rows ``carry`` (doc_id, if not given), ``quality`` (the counts), ``base_failed`` and ``kept`` for every row of ``docs``.

    ``docs``: doc_id, text, lang. ``labels``: doc_id, quality (1: good). The
    counts are written once to the shared folder; cutoffs and verdicts read
    them there.
    """
    kept_columns = carry or ["doc_id"]
    measured = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("row"), F.col("doc_id"), stratum(F.col("lang").cast("string")).alias("stratum"), measures(F.col("text").cast("string")).alias("quality"))
    rows = staged(measured, "quality").withColumn("levels", F.array(*rule_levels(F.col("quality")))).withColumn("base_failed", base_failed(F.col("quality")))
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("good")).where(F.col("good") == 1).select("doc_id")
    held_out = rows.where(~F.col("base_failed")).select("doc_id", "stratum", "levels").join(good, "doc_id", "left_semi")
    cut = broadcast_if_small(staged(cutoffs(held_out, max_false_rejection, error), "cutoffs"))  # one row a stratum
    above = F.forall(F.arrays_zip(F.col("levels"), F.col("cut")), lambda x: x["levels"] > x["cut"])
    return rows.join(cut, "stratum", "left").select("row.*", "quality", "base_failed", (~F.col("base_failed") & F.coalesce(above, F.lit(True))).alias("kept"))


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with all their columns."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    need = {c: F.col(f"c{docs.columns.index(c)}").alias(c) for c in ("doc_id", "text", "lang")}
    judged = judge(numbered.select("*", *need.values()), labels, carry=numbered.columns)
    return judged.where("kept").select(*numbered.columns).toDF(*docs.columns)
