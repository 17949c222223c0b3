"""Line-first cleaning, in DataFrame functions only.

Lines (\\n-split, with a word) are judged one by one and failures are removed; a document is rejected where the lines
that stay hold too little of its text, or where the base measures fail. A line fails by
- punctuation: no sentence mark that ends a word, or runs of marks at every third word or more;
- navigation: at least two separators, and one to at most four words;
- boilerplate: a phrase of site furniture, or a line equal to an earlier one of the document.

Defined results: null text has no words; a document without lines is rejected (it has too few words); ties do not arise;
repeated rows are judged alike; an empty table gives an empty table; very long texts cost n log n in their words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, n_words

#: Reject where more than this percentage of the lines' characters is removed.
MOST_LOST = 50
#: Fixed phrases, lower case.
PHRASES = "all rights reserved|cookie policy|accept cookies|privacy policy|terms of service|terms of use|enable javascript|click here|sign up for|subscribe to our|skip to content|back to top|log in to|share this"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK_END = r"""[.!?\x{2026}:;]["')\x{BB}]*([\x20\x09-\x0D]|\z)"""
MARK_RUN = r"[!?#*$%&=~_]{2,}"
SEPARATOR = r"[|\x{BB}\x{203A}\x{2022}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, even where body names it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """How many words of an array lie in a three-word window that occurs in it at least twice.

    Windows are sorted by hash and place packed in one long; equal neighbours are compared word by word, so a hash
    collision counts nothing.
    """

    def measured(w: Column) -> Column:
        m = F.size(w) - 2
        bits = F.coalesce(F.ceil(F.log2(m + F.lit(1.5))), F.lit(0)).cast("int")

        def packed(x: Column, i: Column) -> Column:
            return F.coalesce(F.call_function("shiftleft", F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)), bits).bitwiseOR(i.cast("long")), F.lit(0))

        keys = F.sort_array(F.transform(F.slice(w, F.lit(1), F.greatest(m, F.lit(0))), packed))

        def found(k: Column) -> Column:
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

            def same(x: Column, y: Column) -> Column:
                p, q = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
                equal = [F.get(w, p + d) == F.get(w, q + d) for d in range(3)]
                near = F.call_function("shiftrightunsigned", x.bitwiseXOR(y), bits) == 0
                return F.coalesce(near & equal[0] & equal[1] & equal[2], F.lit(False))

            hit = F.filter(k, lambda x, i: F.when(i > 0, same(x, F.get(k, i - 1))).otherwise(F.lit(False)) | same(x, F.get(k, i + 1)))
            places = F.transform(hit, lambda x: x.bitwiseAND(mask))
            return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))

        return F.when(m < 2, F.lit(0)).otherwise(let(keys, found))

    return let(words, measured)


def line_fails(line: Column) -> Column:
    """Whether a line fails by itself (copies of earlier lines are left to the document)."""
    words = F.regexp_count(line, F.lit(WORD))
    punctuation = ~line.rlike(MARK_END) | (F.regexp_count(line, F.lit(MARK_RUN)) * 3 >= words)
    bars = F.regexp_count(line, F.lit(SEPARATOR))
    navigation = (bars >= 2) & (bars * 4 >= words)
    return punctuation | navigation | F.translate(line, UPPER, LOWER).rlike(PHRASES)


def measures(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and clean_text.

    Columns of docs with these names are replaced.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text"]
    docs = docs.drop(*names)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPACE + "+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    chars = F.length(text) - F.regexp_count(text, F.lit(SPACE))

    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + F.length(x))

    def judged(ls: Column) -> Column:
        return let(
            F.array_distinct(F.filter(ls, lambda x: ~line_fails(x))),
            lambda good: F.struct(
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("dup"),
                ((total(ls) - total(good)) * 100 > total(ls) * MOST_LOST).alias("lost"),
                F.array_join(good, "\n").alias("clean"),
            ),
        )

    out = docs.withColumns({"n_words": n_words(text), "word_chars": chars.cast("long"), "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"), "_lines": let(lines, judged), "n_repeat_words": repeated_words(words).cast("long")})
    out = out.withColumn("n_dup_lines", F.col("_lines.dup"))
    out = out.withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
    out = out.withColumn("kept", ~F.col("base_failed") & ~F.col("_lines.lost")).withColumn("clean_text", F.col("_lines.clean"))
    return out.select(*docs.columns, *names)


#: The same for DuckDB, over documents with different ids.
ORACLE = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
  FROM d
), n AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(text) - len(regexp_extract_all(text, '{SPACE}')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(list_sum(list_transform(lines, lambda x: length(x))), 0) AS all_chars,
    coalesce(list_sum(list_transform(list_distinct(list_filter(lines, lambda x:
      regexp_matches(x, '{MARK_END.replace("'", "''")}')
      AND len(regexp_extract_all(x, '{MARK_RUN}')) * 3 < len(regexp_extract_all(x, '{WORD}'))
      AND NOT (len(regexp_extract_all(x, '{SEPARATOR}')) >= 2
               AND len(regexp_extract_all(x, '{SEPARATOR}')) * 4 >= len(regexp_extract_all(x, '{WORD}')))
      AND NOT regexp_matches(translate(x, '{UPPER}', '{LOWER}'), '{PHRASES}')
    )), lambda x: length(x))), 0) AS good_chars
  FROM w
), g AS (
  SELECT doc_id, p, words[p] AS a, words[p + 1] AS b, words[p + 2] AS c FROM w, range(1, len(words) - 1) AS r(p)
), t AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, a, b, c) AS times FROM g
), r AS (
  SELECT doc_id, count(DISTINCT p + o) AS n_repeat_words FROM t, (VALUES (0), (1), (2)) AS v(o) WHERE times > 1 GROUP BY doc_id
)
SELECT n.doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
  n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words)
    AND NOT (all_chars - good_chars) * 100 > all_chars * {MOST_LOST} AS kept
FROM n LEFT JOIN r ON n.doc_id = r.doc_id
"""
