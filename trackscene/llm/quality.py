"""Quality rules (operator 7): a threshold table compiled into native column expressions, no user functions.

``compile_rules`` turns the table (measure, least, most) into one projection;
the measures it names are array and string functions over the words of each
row.  Nothing is shuffled, and the work of a row grows as n log n with its
number of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, WS, column, pack, text_of

SYMBOLS = "#*$%&|<>"
#: Frequent function words of the languages that the rules know.
STOP_WORDS = {
    "en": ["a", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with"],
    "de": ["auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "im", "in", "ist", "mit", "nicht", "sich", "und", "von", "zu"],
    "fr": ["au", "avec", "dans", "de", "des", "du", "elle", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une"],
    "es": ["al", "con", "de", "del", "el", "en", "es", "la", "las", "lo", "los", "no", "para", "por", "que", "se", "su", "un", "una", "y"],
}
#: (measure, least, most): a document passes a rule when its measure lies within; None is no bound.
RULES = (
    ("words", 50, None),
    ("repeated_word_ratio", None, 0.5),
    ("mean_word_length", 2.0, 20.0),
    ("symbol_word_ratio", None, 0.3),
    ("stop_word_ratio", 0.02, None),
    ("duplicate_line_ratio", None, 0.5),
    ("upper_case_ratio", None, 0.6),
)


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` (row, text) with the counts that the measures use. A null text has no words."""
    d = docs.withColumn("_text", text_of()).withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    n = F.size("_words")
    d = d.withColumn("_n", n.cast("long"))
    # lines with a word, and how many of them equal an earlier line
    lines = F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    d = d.withColumn("_lines", lines)
    # a number for each window of three words; windows found once are told by the distinct count alone
    three = F.when(F.col("_n") >= 3, F.zip_with(
        F.zip_with(F.slice("_words", 1, n - 2), F.slice("_words", 2, n - 2), lambda a, b: F.xxhash64(a, b)),
        F.slice("_words", 3, n - 2), lambda h, c: F.xxhash64(h, c)))
    d = d.withColumn("_three", three)
    d = d.withColumn("_repeats", F.size("_three") > F.size(F.array_distinct("_three")))
    in_order = F.sort_array(F.transform("_three", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_sorted", F.when(F.col("_repeats"), in_order))
    twice = F.filter("_sorted", lambda x, i: (x["h"] == F.get(F.col("_sorted"), i - 1)["h"])
                     | (x["h"] == F.get(F.col("_sorted"), i + 1)["h"]))
    d = d.withColumn("_at", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # each repeated window covers 3 words, less those that the next one covers too
    covered = F.aggregate("_at", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                          lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
                          lambda s: s["n"])
    stops = sorted({w for ws in STOP_WORDS.values() for w in ws})
    n_stop = F.regexp_count(F.lower("_text"), F.lit(rf"(?<![^{WS}])(?:{'|'.join(stops)})(?=[{WS}.,!?;:]|$)"))
    n_cp = F.char_length("_text")
    counts = {
        "_words": F.col("_n"),
        "_word_chars": F.char_length(F.translate("_text", " \t\n\x0b\x0c\r", "")).cast("long"),
        "_symbols": (n_cp - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long"),
        "_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_lines": F.size("_lines").cast("long"),
        "_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "_stops": n_stop.cast("long"),
        "_upper": (n_cp - F.char_length(F.regexp_replace("_text", r"\p{Lu}", ""))).cast("long")}
    # a generated row, so that a filter on a verdict is not moved below and evaluated over and over inside the counts
    one = F.array(F.struct(*[v.alias(k) for k, v in counts.items()]))
    return d.select("row", F.inline(one).alias(*counts)).withColumnRenamed("_words", "_n")


def measures() -> dict[str, Column]:
    """Each measure as an expression over the counts; a ratio over nothing is null, and a null breaks no rule."""
    n, c = F.col("_n"), F.col
    return {
        "words": n.cast("double"),
        "word_chars": c("_word_chars").cast("double"),
        "mean_word_length": F.try_divide(c("_word_chars"), n),
        "symbol_word_ratio": F.try_divide(c("_symbols"), n),
        "stop_word_ratio": F.try_divide(c("_stops"), n),
        "duplicate_line_ratio": F.try_divide(c("_dup_lines"), c("_n_lines")),
        "repeated_word_ratio": F.try_divide(c("_repeat_words"), n),
        "upper_case_ratio": F.try_divide(c("_upper"), c("_word_chars")),
    }


def compile_rules(rules=RULES) -> Column:
    """The table as one expression: the names of the rules that a row breaks."""
    known, broken = measures(), []
    for name, least, most in rules:
        x = known[name]
        bad = F.lit(False)
        if least is not None:
            bad = bad | F.coalesce(x < F.lit(float(least)), F.lit(False))
        if most is not None:
            bad = bad | F.coalesce(x > F.lit(float(most)), F.lit(False))
        broken.append(F.when(bad, F.lit(name)))
    return F.array_compact(F.array(*broken))


def apply_rules(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and broken.

    Null and empty texts have no words and fail the base rules (50 words; at
    most half of the words in repeated windows); nulls elsewhere do no harm.
    Every row is judged by itself, so ties and repeated rows come out alike and
    an empty table gives no rows.  Input columns of the names added are replaced.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken")
    d = with_counts(pack(docs, text=column(text)))
    base = (F.col("_n") < 50) | (100 * F.col("_repeat_words") > 50 * F.col("_n"))
    d = d.withColumns({"base_failed": base, "broken": compile_rules(rules)})
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in names]
    return d.select(*rest, F.col("_n").alias("n_words"), F.col("_word_chars").alias("word_chars"),
                    F.col("_symbols").alias("n_symbols"), F.col("_dup_lines").alias("n_dup_lines"),
                    F.col("_repeat_words").alias("n_repeat_words"), "base_failed",
                    (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), "broken")


def query(docs: DataFrame) -> DataFrame:
    d = apply_rules(docs.select("doc_id", "text"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
three AS (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM three) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(w, lambda x: regexp_matches(lower(x), '^(?:@STOPS@)(?:[.,!?;:]|$)'))) AS stops, len(regexp_extract_all(t, '\p{Lu}')) AS upper
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id),
n AS (SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars::DOUBLE / n_words BETWEEN 2.0 AND 20.0 AND n_symbols::DOUBLE / n_words <= 0.3 AND stops::DOUBLE / n_words >= 0.02
  AND n_dup_lines::DOUBLE / len(lines) <= 0.5 AND upper::DOUBLE / word_chars <= 0.6 AS kept
FROM n
""".replace("@STOPS@", "|".join(sorted({w for ws in STOP_WORDS.values() for w in ws})))
