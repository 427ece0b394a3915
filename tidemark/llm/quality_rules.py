"""Quality rules with risk-controlled cutoffs, built-in functions only.

Base rules drop very short and very repetitive texts. Beyond them, each
``Rule`` rejects a text whose value is over a cutoff. Cutoffs are not set by
hand: a labelled holdout shows, for each stratum, rule and candidate cutoff,
how many good texts the rule would reject. A cutoff may be used only if an
exact binomial test shows that it rejects at most a share ``alpha / rules`` of
good texts, i.e. if the upper Clopper-Pearson bound of the false rejection
rate is below that share. Errors over all strata and rules together stay
below ``delta``: by Bonferroni between stratum-rule pairs, and within a pair by
testing cutoffs from the most lenient on and stopping at the first that fails
(the candidates are fixed in advance). So with probability 1 - delta, in every
stratum all rules together reject at most a share ``alpha`` of good texts that
pass the base rules. Among proven cutoffs the one with the largest gain (share
of bad texts minus share of good texts rejected) is used, if it is positive.
A stratum without enough labels keeps the base rules alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir

ALPHA = 0.05
DELTA = 0.05
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
#: Terms of a binomial tail that are always summed one by one, and how many
#: more for each square root of a trial (see ``binomial_tail``).
TAIL_TERMS, TAIL_PER_ROOT = 2000, 64

_SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class Rule:
    """Rejects rows whose ``value`` (SQL over the features) exceeds a cutoff;
    ``cutoffs`` go from lenient to strict."""
    name: str
    value: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols_per_word", "n_symbols / n_words", (2.0, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("dup_line_share", "n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("repeat_share", "n_repeat_words / n_words", (0.28, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("upper_share", "n_upper / greatest(word_chars, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    Rule("marks_per_word", "n_marks / n_words", (5.0, 3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.4)),
    Rule("mean_word_length", "word_chars / n_words", (30.0, 20.0, 15.0, 12.0, 11.0, 10.0, 9.0)),
)


def _length_without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id, stratum, text_sha256``, the features and ``base_failed`` of
    every row. A null text has no words. A null stratum is the stratum ``none``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{_SPACE}]"))
    d = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("none")).alias("stratum"),
        F.sha2(text, 256).alias("text_sha256"),
        F.transform(F.regexp_extract_all(text, F.lit(f"[^{_SPACE}]+"), F.lit(0)), lambda w: F.xxhash64(w)).alias("h"),
        lines.alias("lines"),
        _length_without(text, f"[{_SPACE}]+").alias("word_chars"),
        _length_without(text, "[^#*$%&|<>]+").alias("n_symbols"),
        _length_without(text, r"[^\p{Lu}]+").alias("n_upper"),
        _length_without(text, "[^!?]+").alias("n_marks"))
    other = ["doc_id", "stratum", "text_sha256", "word_chars", "n_symbols", "n_upper", "n_marks"]
    n_lines = F.size("lines").cast("long")
    d = d.select(*other, "h", n_lines.alias("n_lines"), (n_lines - F.size(F.array_distinct("lines"))).alias("n_dup_lines"))
    other += ["n_lines", "n_dup_lines"]

    # Windows found twice: sorted with their places, equal ones are neighbours.
    w = REPEAT_WINDOW
    runs = F.transform(F.sequence(F.lit(0), F.size("h") - F.lit(w)),
                       lambda i: F.xxhash64(*[F.get(F.col("h"), i + F.lit(j)) for j in range(w)]))
    none = F.array().cast("array<bigint>")
    d = d.select(*other, F.size("h").cast("long").alias("n_words"), F.when(F.size("h") >= w, runs).otherwise(none).alias("runs"))
    other += ["n_words"]
    twice = F.size("runs") > F.size(F.array_distinct("runs"))
    placed = F.array_sort(F.transform("runs", lambda x, i: F.struct(x.alias("run"), i.alias("at"))))
    d = d.select(*other, F.when(twice, placed).alias("placed"))

    marked = F.filter("placed", lambda x, i: F.coalesce(F.get("placed", i - F.lit(1))["run"] == x["run"], F.lit(False)) |
                      F.coalesce(F.get("placed", i + F.lit(1))["run"] == x["run"], F.lit(False)))
    d = d.select(*other, F.sort_array(F.transform(marked, lambda x: x["at"])).alias("at"))
    steps = F.transform("at", lambda x, i: F.least(F.lit(w), F.coalesce(F.get("at", i + F.lit(1)) - x, F.lit(w))))
    covered = F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))
    d = d.select(*other, covered.alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    return d.withColumn("base_failed", failed)


def log_gamma(x: Column) -> Column:
    """ln Gamma of x >= 1, by Stirling's series beyond 8."""
    z = x + 7.0
    shift = sum((F.log(x + float(i)) for i in range(1, 7)), F.log(x))
    return ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (z * 12)
            - 1 / (F.pow(z, F.lit(3)) * 360) + 1 / (F.pow(z, F.lit(5)) * 1260) - 1 / (F.pow(z, F.lit(7)) * 1680) - shift)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), 1 where k is not below n * p. Exact up
    to rounding at any size: where k is a standard deviation or more below
    n * p, the terms after the summed ones add less than 2 ** -53 of the sum;
    closer to n * p the result is above 0.1 and the rest is bounded from above."""
    top = (log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)
           + k * math.log(p) + (n - k) * math.log1p(-p))
    odds = (1 - p) / p

    def step(acc: Column, j: Column) -> Column:
        t = acc["t"] * (k - j) * odds / (n - k + j + 1.0)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    used = F.least(k, TAIL_TERMS + F.ceil(F.sqrt(n) * TAIL_PER_ROOT)).cast("int")
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
    # Step j multiplies by (k - j) / (n - k + j + 1): the last one is 0.
    acc = F.aggregate(F.sequence(F.lit(0), used), start, step)
    ratio = (k - used) * odds / (n - k + used + 1.0)
    rest = acc["t"] * ratio / (1 - ratio)
    return F.when(k < n * p, F.least(F.exp(top) * (acc["s"] + rest), F.lit(1.0))).otherwise(F.lit(1.0))


def select_cutoffs(labelled: DataFrame, rules=RULES, *, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum, rule, cutoff`` from rows of features and ``good``
    (boolean): at most one row per stratum and rule."""
    per_rule = alpha / len(rules)
    values = F.array(*[F.struct(
        F.lit(r.name).alias("rule"),
        sum((F.when(F.expr(r.value) > c, 1).otherwise(0) for c in r.cutoffs), F.lit(0)).alias("fails")) for r in rules])
    counts = (labelled.where("not base_failed").select("stratum", "good", F.inline(values))
              .groupBy("stratum", "rule", "fails").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    # A row over f cutoffs is over the f strictest, the last ones.
    grid = [(r.name, i, c, len(r.cutoffs) - i) for r in rules for i, c in enumerate(r.cutoffs)]
    grid = labelled.sparkSession.createDataFrame(grid, "rule string, step int, cutoff double, at_least int")
    totals = counts.groupBy("stratum", "rule").agg(F.sum("good").alias("n"), F.sum("bad").alias("n_bad"))
    n_strata = totals.agg(F.countDistinct("stratum")).scalar()
    at = (totals.join(grid, "rule").join(counts.select(F.col("stratum").alias("s"), F.col("rule").alias("r"), "fails", "good", "bad"),
                                         (F.col("stratum") == F.col("s")) & (F.col("rule") == F.col("r")) & (F.col("fails") >= F.col("at_least")), "left")
          .groupBy("stratum", "rule", "step", "cutoff", "n", "n_bad")
          .agg(F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k_bad")))
    lenient_first = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    level = F.lit(delta) / (n_strata * len(rules))
    tested = (at.withColumn("n", F.col("n").cast("double"))
              .withColumn("p_value", binomial_tail(F.col("k"), F.col("n"), per_rule))
              .withColumn("proven", F.min(F.col("p_value") <= level).over(lenient_first))
              .withColumn("gain", F.when(F.col("n_bad") > 0, F.col("k_bad") / F.col("n_bad")).otherwise(F.lit(0.0))
                          - F.col("k") / F.greatest(F.col("n"), F.lit(1.0))))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), "step")
    return (tested.where("proven and gain > 0").withColumn("rank", F.row_number().over(best)).where("rank = 1")
            .select("stratum", "rule", "cutoff"))


def apply_rules(spark: SparkSession, docs: DataFrame, labels: DataFrame, rules=RULES, *, alpha: float = ALPHA,
                delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                good: str = "quality = 1") -> DataFrame:
    """All features, ``base_failed``, ``rejected_by`` (names of rules beyond
    the base ones, in order) and ``kept`` of every document row.

    Labels without a verdict are not used; a document with several labels is
    good if one says so. A labelled text is one trial of its stratum however
    many rows or ids have it (good if one of them is), as copies of a text are
    no independent examples. Without labels only the base rules apply. Repeated
    rows each come back, very long texts and other columns of any name are
    fine, and an empty table gives no rows.
    """
    path = scratch_dir(spark, "quality-rules")
    features(docs, id_col=id_col, text_col=text_col, stratum_col=stratum_col).write.parquet(path)
    rows = spark.read.parquet(path)
    marks = labels.select(F.col(id_col).alias("doc_id"), F.expr(good).alias("good")).where("good is not null")
    marks = marks.groupBy("doc_id").agg(F.max("good").alias("good"))
    trials = (rows.join(marks, "doc_id").groupBy(*[c for c in rows.columns if c != "doc_id"]).agg(F.max("good").alias("good")))
    cutoffs = select_cutoffs(trials, rules, alpha=alpha, delta=delta)
    by_stratum = cutoffs.groupBy(F.col("stratum").alias("of")).agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cut_{i}") for i, r in enumerate(rules)])
    joined = rows.join(by_stratum, rows["stratum"] == by_stratum["of"], "left")
    rejected = F.array_compact(F.array(*[
        F.when((F.col("n_words") > 0) & (F.col("n_lines") > 0) & (F.expr(r.value) > F.col(f"cut_{i}")), F.lit(r.name))
        for i, r in enumerate(rules)]))
    return joined.select(*rows.columns, rejected.alias("rejected_by"),
                         (~F.col("base_failed") & (F.size(rejected) == 0)).alias("kept"))
