r"""Rule-based quality filter: one threshold table, one Spark projection.

``RULES`` lists (name, measure, least, most).  The table is compiled into a
single native projection: measures of length, symbols, stop words and lines,
then one comparison per rule.  No user function runs.

The stop-word rule knows the languages of ``STOP_LANGUAGES``: where a row's
``lang`` names another one it does not apply.  Without such a column, or with a
null in it, it does.

Words are ``[^\x20\x09-\x0D]+``.  Repeats are words inside 8-word windows that
occur twice or more; windows are compared by 64-bit hashes within one text.

Defined results: a null or empty text has no words, zero measures and fails
the base rule; ratios over nothing are 0; rows are judged one by one, so ties
and repeated rows get equal results; other columns are kept by
``apply_rules`` and may have any name that does not begin with ``_q_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import let

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
WINDOW = 8

#: Frequent function words of the languages that the rules know (parameter).
STOP_WORDS = (
    # en
    "the of and to in is that it for on was as with be by are from this or an at not have a "
    # de
    "der die das und zu den von mit im des dem ein eine ist nicht auf für sich auch es "
    # fr
    "le la les de du et un une est que dans pour par sur pas au qui avec en "
    # es
    "el los las y del se una con por no su para es lo como al"
).split()

#: name, measure, least, most (either may be None)
RULES = [
    ("too_short", "words", 20, None),
    ("repeats", "repeat_ratio", None, 0.30),
    ("word_length", "mean_word_length", 2.0, 14.0),
    ("symbols", "symbol_ratio", None, 0.10),
    ("shouting", "exclamation_ratio", None, 0.25),
    ("capitals", "capital_ratio", None, 0.40),
    ("few_stop_words", "stop_word_ratio", 0.02, None),
    ("repeated_lines", "dup_line_ratio", None, 0.50),
]


#: languages of the stop words; the rule that counts them judges no other
STOP_LANGUAGES = ("en", "de", "fr", "es")
STOP_RULE = "few_stop_words"


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def among(found: Column, chars: str) -> Column:
    """How many of the characters found are in ``chars``."""
    return F.size(F.filter(found, lambda c: c.isin(*chars))).cast("long")


def repeated_words(hashes: Column) -> Column:
    """Words inside 8-word windows that occur twice or more, from word hashes."""
    n = WINDOW

    def covered(places: Column) -> Column:  # sorted starts of repeated windows
        step = F.aggregate(
            places, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("upto")),
            lambda a, p: F.struct((a["sum"] + p + F.lit(n) - F.greatest(p, a["upto"])).alias("sum"), (p + F.lit(n)).alias("upto")),
            lambda a: a["sum"])
        return step

    def by_hash(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            again = F.filter(s, lambda x, k: (F.get(s, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"])))
            return covered(F.array_sort(F.transform(again, lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(pairs, repeated))

    # hashes of 2, 4 and 8 words, each from two of the width before
    def wider(h: Column, by: int, then) -> Column:
        return let(F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + by))), then)

    def windows_of(h: Column) -> Column:
        some = wider(h, 1, lambda h2: wider(h2, 2, lambda h4: wider(h4, 4, lambda h8: by_hash(F.slice(h8, 1, F.size(h) - (n - 1))))))
        return F.when(F.size(h) > n, some).otherwise(F.lit(0))
    return let(hashes, windows_of)


def measure(docs: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """Add the counts of each text as ``_q_*`` columns."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = (docs.withColumn("_q_w", split_words(text))
         .withColumn("_q_c", F.regexp_extract_all(text, F.lit(f"[{SYMBOLS}{MARKS}A-Z]"), F.lit(0))))
    lines = F.filter(F.split(text, "\n"), lambda x: F.ltrim(x, F.lit(SPACE)) != "")
    stop = [F.lit(w) for w in dict.fromkeys(stop_words)]
    counts = {
        "_q_words": F.size("_q_w").cast("long"),
        "_q_word_chars": F.aggregate("_q_w", F.lit(0).cast("long"), lambda a, w: a + F.length(w)),
        "_q_symbols": among(F.col("_q_c"), SYMBOLS),
        "_q_marks": among(F.col("_q_c"), MARKS),
        "_q_capitals": (F.size("_q_c") - F.size(F.filter("_q_c", lambda c: c.isin(*SYMBOLS, *MARKS)))).cast("long"),
        "_q_lines": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("d"))),
        "_q_stop": F.size(F.filter("_q_w", lambda w: F.lower(F.rtrim(w, F.lit(".,;:"))).isin(*stop))).cast("long"),
        "_q_repeats": repeated_words(F.transform("_q_w", lambda w: F.xxhash64(w))).cast("long"),
    }
    return d.select(*[F.col(f"`{c}`") for c in docs.columns], *[v.alias(k) for k, v in counts.items()])


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


MEASURES = {
    "words": lambda: F.col("_q_words"),
    "repeat_ratio": lambda: _ratio("_q_repeats", "_q_words"),
    "mean_word_length": lambda: _ratio("_q_word_chars", "_q_words"),
    "symbol_ratio": lambda: _ratio("_q_symbols", "_q_words"),
    "exclamation_ratio": lambda: _ratio("_q_marks", "_q_words"),
    "capital_ratio": lambda: _ratio("_q_capitals", "_q_word_chars"),
    "stop_word_ratio": lambda: _ratio("_q_stop", "_q_words"),
    "dup_line_ratio": lambda: F.when(F.col("_q_lines.n") > 0, (F.col("_q_lines.n") - F.col("_q_lines.d")) / F.col("_q_lines.n")).otherwise(0.0),
}


def compile_rules(rules=RULES) -> dict[str, Column]:
    """One boolean "fails" expression for each row of the threshold table."""
    out = {}
    for name, what, least, most in rules:
        fails, value = F.lit(False), MEASURES[what]()
        if least is not None:
            fails = fails | (value < F.lit(least))
        if most is not None:
            fails = fails | (value > F.lit(most))
        out[name] = fails
    return out


def judge(docs: DataFrame, rules=RULES, stop_words=STOP_WORDS) -> DataFrame:
    """``docs`` with the ``_q_*`` counts, ``_q_base_failed``, ``_q_failed``
    (names of the rules that reject) and ``_q_kept``."""
    base = (F.col("_q_words") < 20) | (100 * F.col("_q_repeats") > 30 * F.col("_q_words"))
    compiled = compile_rules(rules)
    if STOP_RULE in compiled and "lang" in docs.columns:
        compiled[STOP_RULE] = compiled[STOP_RULE] & F.coalesce(F.col("lang").isin(*STOP_LANGUAGES), F.lit(True))
    names = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in compiled.items()]))
    return (measure(docs, stop_words).withColumn("_q_base_failed", base).withColumn("_q_failed", names)
            .withColumn("_q_kept", ~F.col("_q_base_failed") & (F.size("_q_failed") == 0)))


def quality_report(docs: DataFrame, rules=RULES) -> DataFrame:
    """Per document: the base counts, base_failed, failed_rules and kept."""
    return judge(docs.select("doc_id", "text", *[c for c in docs.columns if c == "lang"]), rules).select(
        "doc_id", F.col("_q_words").alias("n_words"), F.col("_q_word_chars").alias("word_chars"),
        F.col("_q_symbols").alias("n_symbols"), (F.col("_q_lines.n") - F.col("_q_lines.d")).alias("n_dup_lines"),
        F.col("_q_repeats").alias("n_repeat_words"), F.col("_q_base_failed").alias("base_failed"),
        F.array_join("_q_failed", ",").alias("failed_rules"), F.col("_q_kept").alias("kept"))


def apply_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents that no rule rejects, same columns.

    The verdict passes a generator of one row, below which a filter on it is not
    pushed: the measures are evaluated once, not again inside the filter."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    verdict = F.inline(F.array(F.struct(F.col("_q_kept").alias("_q_verdict"))))
    return judge(docs, rules).select(*kept, verdict).filter("_q_verdict").select(*kept)
