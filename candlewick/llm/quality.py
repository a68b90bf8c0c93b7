"""Quality rules with risk-controlled thresholds.

Signals of every text are computed row by row; one cutoff per signal is a
level, and the levels are nested from loose to strict.  A labelled holdout then
picks the level of each stratum: the strictest one whose false rejection rate
of good documents is, by the exact binomial bound, at most ``risk``.  Levels
are tested from the loosest on and the first that fails ends the sequence, so
no correction among them is due; the confidence ``1 - delta`` holds over all
strata together (Bonferroni).  Good documents are those that pass the base
rule, and equal texts count once, as copies are no independent evidence.  A
stratum whose labels cannot certify the loosest level rejects nothing by them.
All steps are DataFrame expressions; texts are read once and only the narrow
signal table is shuffled, by document id, to meet its labels.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.rows import packed, unpacked
from candlewick.session import written

# White space between words, and symbol characters.
SPACE_RE = r"[\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

# Signals (high is bad) over the columns of ``text_signals``, and their cutoff
# at every level, loosest first.
SIGNALS = {
    "symbols": ("n_symbols / greatest(n_words, 1)", [2.0, 1.0, 0.7, 0.5, 0.4, 0.3]),
    "shouts": ("n_shouts / greatest(n_words, 1)", [2.0, 1.0, 0.7, 0.5, 0.4, 0.3]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", [0.2, 0.19, 0.18, 0.17, 0.16, 0.15]),
    "copied_lines": ("n_dup_lines / greatest(n_lines, 1)", [0.8, 0.7, 0.6, 0.5, 0.45, 0.4]),
    "one_word": ("top_word / greatest(n_words, 1)", [0.8, 0.7, 0.6, 0.5, 0.45, 0.4]),
}
RISK, DELTA = 0.03, 0.05


def text_signals(text: Column, df: DataFrame) -> DataFrame:
    """``df`` with counts of ``text`` in columns of type long: ``n_words``,
    ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` and,
    for the signals, ``n_lines`` (with a word), ``n_shouts`` (``!``) and
    ``top_word`` (occurrences of the longest run of one word).  ``df`` must
    not have such columns; see ``quality_rules`` for clashing names."""
    d = df.withColumn("_t", F.coalesce(text, F.lit("")))
    d = (d.withColumn("_w", F.transform(F.filter(F.split("_t", SPACE_RE), lambda w: w != ""),
                                        lambda w: F.xxhash64(w)))
         .withColumn("_l", F.filter(F.split("_t", "\n"),
                                    lambda x: F.btrim(x, F.lit(SPACE)) != "")))
    d = d.withColumn("n_words", F.size("_w").cast("long"))
    w = F.col("_w")
    span = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
    d = d.withColumn("_g", F.when(F.col("n_words") >= WINDOW,
                                  F.transform(F.sequence(F.lit(0), F.size("_w") - WINDOW), span))
                     .otherwise(F.array().cast("array<long>")))
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    d = d.withColumn("_s", F.when(repeats, F.sort_array(F.transform(
        "_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, k: F.coalesce(F.get("_s", k)["h"] == x["h"], F.lit(False))
    d = d.withColumn("_p", F.sort_array(F.transform(
        F.filter("_s", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(
            F.get("_p", k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b)
    run = F.aggregate(
        "_w", F.struct(F.lit(None).cast("long").alias("w"), F.lit(0).alias("n"), F.lit(0).alias("m")),
        lambda a, x: F.struct(
            x.alias("w"),
            F.when(a["w"] == x, a["n"] + 1).otherwise(F.lit(1)).alias("n"),
            F.greatest(a["m"], F.when(a["w"] == x, a["n"] + 1).otherwise(F.lit(1))).alias("m")))["m"]
    left = lambda chars: F.char_length("_t") - F.char_length(
        F.translate("_t", chars, ""))
    return d.select(
        *df.columns, "n_words",
        (F.char_length("_t") - left(SPACE)).cast("long").alias("word_chars"),
        left(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_l").cast("long").alias("n_lines"),
        left("!").cast("long").alias("n_shouts"),
        run.cast("long").alias("top_word"))


def _lgamma(x: Column) -> Column:
    """ln Gamma(x), x > 0, to about 1e-13: Stirling's series at x + 10."""
    z = x + 10.0
    shift = F.log(x)
    for k in range(1, 10):
        shift = shift + F.log(x + float(k))
    return ((z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi)
            + 1 / (12.0 * z) - 1 / (360.0 * z * z * z) + 1 / (1260.0 * z * z * z * z * z) - shift)


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), k < n p: the term at k times the falling
    ratios of the terms below it, summed until they vanish (a number of
    terms of the order of the standard deviation)."""
    k, n = k.cast("double"), n.cast("double")
    log_term = (_lgamma(n + 1.0) - _lgamma(k + 1.0) - _lgamma(n - k + 1.0)
                + k * math.log(p) + (n - k) * math.log1p(-p))
    terms = F.least(k, F.ceil(12.0 * F.sqrt(n * p) + 64.0)).cast("long")
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), terms),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, j: F.struct(
            (a["sum"] + a["term"]).alias("sum"),
            (a["term"] * (k - j) * (1 - p) / ((n - k + j + 1.0) * p)).alias("term")))["sum"]
    return F.exp(log_term) * total


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def certified_levels(good: DataFrame, *, signals=SIGNALS, risk: float = RISK, delta: float = DELTA,
                     strata: int | None = None) -> DataFrame:
    """One row per stratum: ``level`` (the strictest certified one, from 1;
    0 if none), ``n`` and a column per signal with its cutoff at that level.

    ``good`` has a row per independent good text of a ``stratum``, with the
    columns of the signals.  ``strata`` is the number of strata that the
    confidence is shared by (default: those of ``good``)."""
    levels = len(next(iter(signals.values()))[1])
    over = lambda i: reduce(or_, [F.expr(e) > F.lit(cuts[i]) for e, cuts in signals.values()])
    counts = good.groupBy("stratum").agg(F.count("*").alias("n"), *[
        F.count_if(over(i)).alias(f"k_{i}") for i in range(levels)])
    counts = written(counts, "quality-counts")
    alpha = delta / max(1, strata or counts.count())
    sure, level = F.lit(True), F.lit(0)
    for i in range(levels):
        k, n = F.col(f"k_{i}"), F.col("n")
        sure = sure & (k < n * risk) & (binomial_cdf(k, n, risk) <= alpha)
        level = level + sure.cast("int")
    counts = counts.withColumn("level", level)
    cut = lambda cuts: F.get(F.array(*[F.lit(float(c)) for c in cuts]), F.col("level") - 1)
    return counts.select("stratum", "n", "level", *[
        F.when(F.col("level") > 0, cut(cuts)).alias(f"cut_{s}") for s, (_, cuts) in signals.items()])


def good_texts(table: DataFrame, labels: DataFrame, label_id: str) -> DataFrame:
    """The distinct good texts of every stratum, from signal rows (``id``,
    ``stratum``, ``th``: hash of the text): a text is good if all labels of
    all rows that say it are 1, and it passes the base rule."""
    marks = (labels.select(F.col(label_id).alias("l_id"), F.col("quality").alias("q"))
             .where("l_id IS NOT NULL AND q IS NOT NULL").groupBy("l_id").agg(F.min("q").alias("q")))
    sig = [c for c in table.columns if c not in ("id", "stratum", "th")]
    one = (table.join(marks, F.col("id") == F.col("l_id")).where(~base_failed()).groupBy("stratum", "th")
           .agg(F.min("q").alias("q"), *[F.first(c).alias(c) for c in sig]))
    return one.where("q = 1").drop("q", "th")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", stratum_col: str = "lang", *,
                  signals=SIGNALS, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Judge every document.

    Returns one row per input row: ``id_col``, the counts of
    ``text_signals``, ``base_failed`` (under ``MIN_WORDS`` words, or over
    ``MAX_REPEAT_PCT`` % of them in repeated windows), ``rejected_by`` (the
    signals over their stratum's cutoff) and ``kept``.  Null text has no
    words and fails the base rule; a null stratum is a stratum of its own.
    Labels (``id_col``, ``quality``): a text is good if all its rows' labels
    say 1; null qualities and ids are skipped.  Rows that repeat an id are
    judged each on its own, texts of any length whole.  Without labels the base
    rule alone decides; no documents give no rows.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).alias("stratum"),
                       F.xxhash64(text_col).alias("th"), F.col(text_col).alias("_text"))
    table = written(text_signals(F.col("_text"), base).drop("_text"), "quality-signals")
    levels = certified_levels(good_texts(table, labels, id_col), signals=signals, risk=risk, delta=delta)
    return judged(table, levels, signals).drop("stratum", "th").withColumnRenamed("id", id_col)


def judged(table: DataFrame, levels: DataFrame, signals=SIGNALS) -> DataFrame:
    """Signal rows with ``base_failed``, ``rejected_by`` and ``kept``."""
    cuts = levels.drop("n", "level").withColumnRenamed("stratum", "c_stratum")
    rows = table.join(cuts, F.col("stratum").eqNullSafe(F.col("c_stratum")), "left")
    over = F.array_compact(F.array(*[F.when(F.expr(e) > F.col(f"cut_{s}"), F.lit(s))
                                     for s, (e, _) in signals.items()]))
    return (rows.withColumn("base_failed", base_failed()).withColumn("rejected_by", over)
            .withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
            .select(*table.columns, "base_failed", "rejected_by", "kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` (all columns) that ``quality_rules`` keeps.  The
    verdict is a function of a row's text and stratum, so it meets the rows
    by (id, stratum, text hash) and repeated rows stay repeated."""
    named = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).alias("stratum"),
                        F.col(text_col).alias("_text")).withColumn("th", F.xxhash64("_text"))
    table = written(text_signals(F.col("_text"), named).drop("_text"), "quality-signals")
    bad = (judged(table, certified_levels(good_texts(table, labels, id_col))).where(~F.col("kept"))
           .select(F.col("id").alias("b_id"), F.col("stratum").alias("b_s"), F.col("th").alias("b_th"))
           .distinct())
    rows = packed(docs, id=F.col(id_col), stratum=F.col(stratum_col), th=F.xxhash64(text_col))
    return unpacked(rows.join(bad, F.col("id").eqNullSafe(F.col("b_id"))
                              & F.col("stratum").eqNullSafe(F.col("b_s"))
                              & (F.col("th") == F.col("b_th")), "left_anti"))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                        spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    """The same verdicts in DuckDB: windows as exploded rows, the binomial
    bound as a plain sum over lgamma terms."""
    tests = ",\n  ".join(f"('{s}', {i + 1}, {c})" for s, (_, cuts) in SIGNALS.items() for i, c in enumerate(cuts))
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(len(ws) - {WINDOW - 1})) AS p,
             unnest(list_transform(range(1, len(ws) - {WINDOW - 2}),
                                   lambda i: array_to_string(ws[i:i + {WINDOW - 1}], ' '))) AS x
      FROM w WHERE len(ws) >= {WINDOW}),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, x) AS c FROM g) WHERE c > 1),
n AS (SELECT doc_id, sum(least({WINDOW}, coalesce(nxt - p, {WINDOW})))::BIGINT AS n_repeat_words
      FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM r) GROUP BY doc_id),
u AS (SELECT doc_id, unnest(range(len(ws))) AS p, unnest(ws) AS x FROM w),
k AS (SELECT doc_id, max(c) AS top_word FROM
       (SELECT doc_id, x, count(*) AS c FROM
         (SELECT doc_id, x, p - row_number() OVER (PARTITION BY doc_id, x ORDER BY p) AS grp FROM u)
        GROUP BY doc_id, x, grp) GROUP BY doc_id),
s AS (SELECT doc_id, lang, len(ws)::BIGINT AS n_words,
             length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, len(ls) AS n_lines,
             length(t) - length(replace(t, '!', '')) AS n_shouts, coalesce(top_word, 0) AS top_word
      FROM w LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)),
v AS (UNPIVOT (SELECT doc_id, lang, n_words, {", ".join(f"({e})::DOUBLE AS {s}" for s, (e, _) in SIGNALS.items())} FROM s)
      ON {", ".join(SIGNALS)} INTO NAME sig VALUE val),
c(sig, lev, cut) AS (VALUES {tests}),
b AS (SELECT lang, min(doc_id) AS doc_id FROM s JOIN d USING (doc_id, lang) JOIN
        (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) USING (doc_id)
      WHERE n_words >= {MIN_WORDS} AND 100 * n_repeat_words <= {MAX_REPEAT_PCT} * n_words
      GROUP BY lang, t HAVING min(q) = 1),
x AS (SELECT v.doc_id, v.lang, lev, bool_or(val > cut) AS hit FROM v JOIN c USING (sig) GROUP BY ALL),
o AS (SELECT x.lang, lev, count(*) AS n, count(*) FILTER (hit) AS k FROM x JOIN b USING (doc_id) GROUP BY ALL),
z AS (SELECT *, {DELTA} / (SELECT count(DISTINCT coalesce(lang, '')) FROM o) AS level,
             list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                      + j * ln({RISK}) + (n - j) * ln(1 - {RISK})))) AS cdf FROM o),
q AS (SELECT lang, count(*) FILTER (sure) AS lev FROM
        (SELECT lang, bool_and(k < n * {RISK} AND cdf <= level) OVER (PARTITION BY lang ORDER BY lev) AS sure FROM z) GROUP BY lang),
j AS (SELECT x.doc_id, x.hit AS over FROM x JOIN q ON x.lev = q.lev AND x.lang IS NOT DISTINCT FROM q.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(over, false) AS kept
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM s)
LEFT JOIN j USING (doc_id)
"""


OP5_SQL = _sql()
