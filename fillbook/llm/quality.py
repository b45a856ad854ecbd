"""Operator 1, quality rules: a threshold table compiled into one projection.

Everything is built-in Spark SQL: no user function, no shuffle. The counts of a
document are columns of a narrow chain of projections; the threshold table
(``RULES``) is data and becomes one boolean expression over those counts.

Defined results: a null text counts as empty; a text without words has zero
counts and fails the base rule; documents are judged row by row, so repeated
rows and ties get the same verdict; extra input columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillbook.llm.common import SPACE_CLASS, SPACES, register, table

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of the corpus languages.
STOP_WORDS = {
    "en": "the of and to in is that for it as was with be by on not he this are at from or an have",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au plus avec il ne se",
    "es": "de la que el en y los del se las por un para con no una su al lo como más es",
}

#: (rule, numerator, "max" or "min", percent, denominator): the rule holds when
#: 100 * numerator is at most / at least percent * denominator. Whole numbers
#: only, so that every engine decides alike at the threshold.
RULES = (
    ("min_words", "n_words", "min", 1000, "one"),
    ("min_word_length", "word_chars", "min", 200, "n_words"),
    ("max_word_length", "word_chars", "max", 2000, "n_words"),
    ("symbols_per_word", "n_symbols", "max", 10, "n_words"),
    ("stop_words", "n_stop", "min", 4, "n_words"),
    ("duplicate_lines", "n_dup_lines", "max", 50, "n_lines"),
    ("bullet_lines", "n_bullet_lines", "max", 90, "n_lines"),
    ("ellipsis_lines", "n_ellipsis_lines", "max", 30, "n_lines"),
)


def stop_forms() -> list[str]:
    """The stop words as written in a text: lower case and capitalised."""
    words = {w for line in STOP_WORDS.values() for w in line.split()}
    return sorted(words | {w.capitalize() for w in words})


def compile_rules(rules=RULES) -> Column:
    """The threshold table as one boolean expression over the count columns."""
    def one(rule):
        _, num, kind, pct, den = rule
        bound = F.lit(pct) * (F.lit(1) if den == "one" else F.col(den))
        left = F.lit(100) * F.col(num)
        return left <= bound if kind == "max" else left >= bound
    return reduce(lambda a, b: a & b, [one(r) for r in rules])


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside a 5-word window that the text holds twice.

    A window is a 64-bit hash of its five words. Texts whose windows are all
    different (a hash set decides) stop there; in the others (hash, place)
    pairs are sorted, so the cost is n log n for the longest text too, and the
    covered words follow from the gaps between the places of repeated windows.
    """
    n, w = F.col("n_words"), F.col("_words")
    windows = F.when(n > WINDOW, F.transform(
        F.sequence(F.lit(0), (n - WINDOW).cast("int")),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))
    df = df.withColumn("_win", windows)
    df = df.withColumn("_pairs", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    p = F.col("_pairs")
    twin = F.filter(p, lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"]))
    df = df.withColumn("_places", F.sort_array(F.transform(twin, lambda x: x["i"])))
    s = F.col("_places")
    gaps = F.transform(s, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW))))
    total = F.aggregate(gaps, F.lit(0), lambda a, b: a + b)
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long"))


def quality_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the counts that the rules read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col), text.alias("_text"))
    trimmed = F.btrim("_text", F.lit(SPACES))
    df = df.select(
        id_col,
        F.when(trimmed == "", F.array().cast("array<string>"))
         .otherwise(F.split(trimmed, SPACE_CLASS + "+")).alias("_words"),
        F.length(F.translate("_text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("_lines"))
    forms = stop_forms()
    df = df.select(
        id_col, "_words", F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_lines", lambda x: F.substring(x, 1, 1).isin("•", "-", "*"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda x: x.endswith("...") | x.endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("_words", lambda x: x.isin(*forms))).cast("long").alias("n_stop"))
    counts = F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "n_lines", "n_bullet_lines", "n_ellipsis_lines", "n_stop")
    # A one-row generator, or a caller's filter on a count or verdict would be
    # pushed below the projections and repeat all of their work in its condition.
    return _repeat_words(df).select(id_col, F.explode(F.array(counts)).alias("c")).select(id_col, "c.*")


def quality_rules(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document."""
    c = quality_counts(docs, id_col, text_col)
    c = c.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return c.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def _sql() -> str:
    ws = r"[^\x20\x09-\x0D]+"
    def one(rule):
        _, num, kind, pct, den = rule
        return f"100 * {num} {'<=' if kind == 'max' else '>='} {pct} * {'1' if den == 'one' else den}"
    forms = ", ".join("'" + w.replace("'", "''") + "'" for w in stop_forms())
    syms = "[" + "".join("\\" + c for c in SYMBOLS) + "]"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT *, regexp_extract_all(t, '{ws}') AS w,
        [x for x in string_split(t, chr(10)) if trim(x, {spaces}) <> ''] AS ln FROM d),
e AS (SELECT rid, unnest(w) AS w0, unnest(range(len(w))) AS i FROM l),
k AS (SELECT rid, i, CASE WHEN lead(w0, 4) OVER o IS NOT NULL THEN
        [w0, lead(w0, 1) OVER o, lead(w0, 2) OVER o, lead(w0, 3) OVER o, lead(w0, 4) OVER o] END AS g
      FROM e WINDOW o AS (PARTITION BY rid ORDER BY i)),
m AS (SELECT rid, i FROM k WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
r AS (SELECT rid, count(DISTINCT i + j) AS n FROM m, (SELECT unnest(range(5)) AS j) GROUP BY rid),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum([length(x) for x in w]), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '{syms}', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ln) AS BIGINT) AS n_lines,
        CAST(len([x for x in ln if x[1] IN ('•', '-', '*')]) AS BIGINT) AS n_bullet_lines,
        CAST(len([x for x in ln if x LIKE '%...' OR x LIKE '%…']) AS BIGINT) AS n_ellipsis_lines,
        CAST(len([x for x in w if x IN ({forms})]) AS BIGINT) AS n_stop
      FROM l LEFT JOIN r USING (rid)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM c)
SELECT *, (NOT base_failed AND {' AND '.join(one(r) for r in RULES)}) AS kept FROM b"""


@register("op1_quality_rules", _sql())
def op1_quality_rules(spark, sf_dir) -> DataFrame:
    """Quality counts and verdict for every whole text of ``documents``."""
    return quality_rules(table(spark, sf_dir, "documents"))
