"""Quality rules: one threshold table, compiled into one projection.

Every measure is a Spark SQL expression over the whole text; a rule is a row
(name, measure, least, most) of ``RULES``.  There is no user function and no
shuffle: the plan is a scan and projections.

The function words of the languages listed are one list; a text passes its rule with one word in a hundred
from it, or where its letters are of a script that no listed language uses.

Defined results: a null text counts as empty (no words, ``base_failed``); an
empty table gives no rows; rows with equal or null ``doc_id`` are judged one by
one; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm.common import WHITE, bind, documents, words

# Symbols counted by n_symbols.
SYMBOLS = "#*$%&|<>"

# Common function words, a line or two a language (English, German, French, Spanish; Italian, Portuguese,
# Dutch; Swedish, Danish and Norwegian; Polish, Czech; Finnish, Estonian; Hungarian, Romanian, Turkish; Lithuanian, Latvian;
# Indonesian, Tagalog, Swahili; Albanian, Basque, Welsh, Irish; Croatian and Serbian; Russian, Ukrainian, Bulgarian).
STOP_WORDS = (
    "the be to of and that have with is in it for was on as are a this at by from or an "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "de la le les et des en un une du que est pour dans qui au par sur avec "
    "el los las y del se por con para no su lo "
    "di che il non per gli sono della "
    "que não uma os em mais do "
    "het een van niet dat zijn voor "
    "och att det som på ikke og er "
    "nie się na jest że do "
    "je byl ale jako "
    "ja ei oli että see "
    "az és hogy nem egy "
    "și nu este care din "
    "ve bir bu için ile "
    "ir kad yra un "
    "yang dan ini untuk dengan "
    "ang ng sa mga "
    "ya wa kwa ni "
    "dhe të në eta ez yn agus ag "
    "su koji kao "
    "и в не на что с по как это "
    "і що та до з "
    "да се от у је"
).split()

# Letters of scripts (and parts of scripts) that none of these languages is written in, as a
# character class of code point ranges: Greek; further Cyrillic; Armenian to Khmer and Mongolian with Hebrew, Arabic, the scripts
# of India, Thai and Hangul jamo; further Latin; the scripts of East Asia; Hangul; letters beyond the basic plane, without pictures.
OTHER_LETTERS = (
    r"\x{370}-\x{3FF}\x{460}-\x{1CFF}\x{1EA0}-\x{1FFF}\x{2D00}-\x{2DFF}\x{2E80}-\x{D7FF}"
    r"\x{F900}-\x{FDFF}\x{FE70}-\x{FEFC}\x{FF66}-\x{FFDC}\x{10000}-\x{1EFFF}\x{20000}-\x{3FFFF}"
)
#: Share of such letters in a text's words from which the list of function words says nothing about it.
OTHER_SHARE = 0.1

#: A text of fewer words, or with a larger share of repeated words, fails before any rule.
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50


class Rule(NamedTuple):
    name: str
    measure: str  # SQL over the base columns
    least: float | None
    most: float | None
    unless: str | None = None  # SQL over the base columns; where it is true, the rule holds


RULES = (
    Rule("mean_word_length", "word_chars / n_words", 1.5, 20.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.1),
    Rule("stop_word_share", "n_stop_words / n_words", 0.01, None, f"n_other_letters >= {OTHER_SHARE}D * word_chars"),
    Rule("repeated_line_share", "n_dup_lines / n_lines", None, 0.7),
    Rule("ellipsis_line_share", "n_ellipsis_lines / n_lines", None, 0.3),
    Rule("bullet_line_share", "n_bullet_lines / n_lines", None, 0.9),
)


def _count_of(text: Column, chars: str) -> Column:
    """Occurrences of the given ASCII characters: total length less what is left without each."""
    n = F.lit(0).cast("bigint")
    whole = F.octet_length(text)
    for c in chars:
        n = n + (whole - F.octet_length(F.replace(text, F.lit(c), F.lit("")))).cast("bigint")
    return n


def repeat_words(word_array: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, each word counted once.

    Windows are compared by 64-bit hash.  Texts without a repeated window stop
    at the distinct count; the others sort (hash, position) pairs, keep those
    with an equal neighbour, and add up what each window covers beyond the last.
    """

    def covered(hashes):
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(pair):
            repeated = F.filter(
                pair,
                lambda x, j: ((j > 0) & (F.get(pair, j - 1)["h"] == x["h"]))
                | F.coalesce(F.get(pair, j + 1)["h"] == x["h"], F.lit(False)),
            )
            at = F.sort_array(F.transform(repeated, lambda x: x["i"]))
            start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
            return F.aggregate(
                at,
                start,
                lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                lambda a: a["n"],
            )

        zero = F.lit(0).cast("bigint")
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), zero).otherwise(bind(pairs, count))

    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    zero = F.lit(0).cast("bigint")
    return F.when(F.size(word_array) < 4, zero).otherwise(bind(word_array, lambda w: bind(windows(w), covered)))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """doc_id and the counts that the rules read, one row per row of docs; carry adds the input row as ``source_row``."""
    extra = ["source_row"] if carry else []
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        text.alias("text"),
        *([F.struct(*[F.col(c) for c in docs.columns]).alias("source_row")] if carry else []),
    )
    base = base.select("doc_id", "text", words(F.col("text")).alias("w"), F.split("text", "\n").alias("raw"), *extra)
    lines = F.filter("raw", lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    base = base.select("doc_id", "text", "w", lines.alias("lines"), *extra)
    n_chars = F.aggregate("w", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))
    stop = F.filter("w", lambda x: F.lower(x).isin(*dict.fromkeys(STOP_WORDS)))
    ellipsis = F.filter("lines", lambda x: x.endswith("...") | x.endswith("\u2026"))
    bullets = F.filter("lines", lambda x: x.startswith("- ") | x.startswith("* ") | x.startswith("\u2022 "))
    counts = {
        "n_words": F.size("w"),
        "word_chars": n_chars,
        "n_symbols": _count_of(F.col("text"), SYMBOLS),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": repeat_words(F.col("w")),
        "n_lines": F.size("lines"),
        "n_stop_words": F.size(stop),
        "n_other_letters": F.when(F.octet_length("text") == F.length("text"), 0).otherwise(
            F.length(F.regexp_replace("text", f"[^{OTHER_LETTERS}]+", ""))
        ),
        "n_ellipsis_lines": F.size(ellipsis),
        "n_bullet_lines": F.size(bullets),
    }
    return base.select("doc_id", *[c.cast("bigint").alias(k) for k, c in counts.items()], *extra)


def compile_rules(rules=RULES) -> str:
    """The threshold table as one SQL condition, true where every rule holds (a zero divisor holds)."""
    parts = []
    for r in rules:
        top, bottom = r.measure.split(" / ")
        held = [f"{top} >= {r.least}D * {bottom}"] if r.least is not None else []
        held += [f"{top} <= {r.most}D * {bottom}"] if r.most is not None else []
        parts += [f"({h} OR {r.unless})" if r.unless else h for h in held]
    return " AND ".join(parts) or "true"


BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_SHARE} * n_words)"


def quality_rules(
    docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document."""
    m = measures(docs, id_col, text_col)
    return m.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn(
        "kept", F.expr(f"NOT {BASE_FAILED} AND {compile_rules(rules)}")
    )


def kept_documents(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that pass, with all their own columns: the same expressions as a filter, no join."""
    judged = measures(docs, id_col, text_col, carry=True)
    return judged.where(F.expr(f"NOT {BASE_FAILED} AND {compile_rules(rules)}")).select("source_row.*")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(documents(spark, sf_dir))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
