"""Line-first quality rules, in DataFrame functions only.

Every line of a text is tried against punctuation, navigation and boilerplate rules; lines that fail go, and a document that loses
more than ``max_lost_percent`` of its word characters goes as a whole. Base figures of the whole text come along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, let, table

WINDOW = 5
SYMBOLS = "#*$%&|<>"
#: Fixed patterns of the line rules, in syntax that Java and RE2 share.
BOILERPLATE = r"(?i)(all rights reserved|privacy policy|cookie policy|terms of (use|service)|click here|sign (up|in) |log ?in |subscribe (now|to)|share this|powered by|enable javascript|lorem ipsum)"
SEPARATORS = r"[|»›•·]"
MARK_RUNS = r"[!?#*$%&=~_^]{2,}"
NOT_LETTERS = r"[^\p{L}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def line_fails(line: Column, max_mark_percent: int = 25, max_separators: int = 2, max_mark_runs: int = 2) -> Column:
    """True for a line that is mostly marks (punctuation), a row of separated items (navigation), or a stock phrase (boilerplate)."""
    chars = F.length(F.regexp_replace(line, SPACE, ""))
    marks = chars - F.length(F.regexp_replace(line, NOT_LETTERS, ""))
    return (marks * 100 > chars * max_mark_percent) | (F.regexp_count(line, F.lit(MARK_RUNS)) > max_mark_runs) | (F.regexp_count(line, F.lit(SEPARATORS)) > max_separators) | line.rlike(BOILERPLATE)


def repeat_words(words: Column, n: int = WINDOW) -> Column:
    """Words inside ``n``-word windows that stand twice or more in the array.

    Windows are compared by their 64-bit hashes, sorted with their places: linear memory, n log n time, also for very long texts.
    """

    def places(w):
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
        return F.array_sort(F.transform(starts, lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(n)]).alias("h"), i.alias("i"))))

    def twice(s):
        same = lambda a, b: F.coalesce(F.get(s, a)["h"] == b["h"], F.lit(False))
        hit = F.filter(s, lambda x, k: same(k + 1, x) | ((k > 0) & same(F.greatest(k - 1, F.lit(0)), x)))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def covered(d):
        steps = F.transform(d, lambda x, k: F.coalesce(F.least(F.get(d, k + 1) - x, F.lit(n)), F.lit(n)).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    return let(words, lambda w: let(places(w), lambda s: let(twice(s), covered)))


def quality_rules(docs: DataFrame, max_lost_percent: int = 50, min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_chars, clean_text.

    Null and empty texts have no words: they fail the base, aren't kept, and their clean_text is empty. Repeated rows and null ids get a row
    each; other columns are ignored; an empty table gives an empty table; very long texts are taken whole, in time proportional to their length but for one
    sort of their windows. clean_text has the lines that passed, in order.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")
    by_line = F.transform(lines, lambda x: F.struct(x.alias("line"), F.length(F.regexp_replace(x, SPACE, "")).alias("chars"), line_fails(x).alias("fails")))
    with_word = lambda a: F.transform(F.filter(a, lambda x: x["chars"] > 0), lambda x: x["line"])
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x["chars"])
    from_lines = let(by_line, lambda a: F.struct(
        total(a).alias("word_chars"),
        total(F.filter(a, lambda x: x["fails"])).alias("lost_chars"),
        let(with_word(a), lambda b: F.size(b) - F.size(F.array_distinct(b))).cast("long").alias("n_dup_lines"),
        F.array_join(F.transform(F.filter(a, lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("clean_text"),
    ))
    from_words = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    out = docs.select("doc_id", from_words.alias("w"), from_lines.alias("l"), F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"))
    n_words, repeated = F.col("w.n_words"), F.col("w.n_repeat_words")
    failed = (n_words < min_words) | (repeated * 100 > n_words * max_repeat_percent)
    kept = ~failed & (F.col("l.lost_chars") * 100 <= F.col("l.word_chars") * max_lost_percent)
    return out.select("doc_id", n_words, "l.word_chars", "n_symbols", "l.n_dup_lines", repeated, failed.alias("base_failed"), kept.alias("kept"), "l.lost_chars", "l.clean_text")


def op1_quality_rules(spark, sf_dir):
    """The figures, and the text without its failing lines as ``clean_md5``."""
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.withColumn("clean_md5", F.md5(F.col("clean_text").cast("binary"))).drop("clean_text")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
g AS (SELECT r, i, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS gram
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY r, gram) > 1 AS hit FROM g),
c AS (SELECT r, i, max(hit::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS covered FROM h),
n AS (SELECT r, count(*) AS n_words, sum(covered) AS n_repeat_words FROM c GROUP BY r),
x AS (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
y AS (SELECT r, pos, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
             length(regexp_replace(line, '[^\p{L}\p{N}]+', '', 'g')) AS letters,
             len(regexp_extract_all(line, '[!?#*$%&=~_^]{2,}')) AS runs, len(regexp_extract_all(line, '[|»›•·]')) AS seps,
             regexp_matches(line, '(?i)(all rights reserved|privacy policy|cookie policy|terms of (use|service)|click here|sign (up|in) |log ?in |subscribe (now|to)|share this|powered by|enable javascript|lorem ipsum)') AS stock FROM x),
z AS (SELECT r, sum(chars) AS word_chars, count(line) FILTER (WHERE chars > 0) - count(DISTINCT line) FILTER (WHERE chars > 0) AS n_dup_lines,
             md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT ((chars - letters) * 100 > chars * 25 OR runs > 2 OR seps > 2 OR stock)), '')) AS clean_md5,
             coalesce(sum(chars) FILTER (WHERE (chars - letters) * 100 > chars * 25 OR runs > 2 OR seps > 2 OR stock), 0) AS lost_chars FROM y GROUP BY r),
o AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             n_dup_lines::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, lost_chars::BIGINT AS lost_chars, clean_md5
      FROM d LEFT JOIN n USING (r) JOIN z USING (r)),
p AS (SELECT *, (n_words < 10 OR n_repeat_words * 100 > n_words * 20) AS base_failed FROM o)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND lost_chars * 100 <= word_chars * 50) AS kept, lost_chars, clean_md5 FROM p
"""
