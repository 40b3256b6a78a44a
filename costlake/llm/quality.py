"""Quality rules: counts within a text, and lines that stand in too many documents of one host. DataFrame functions only.

Within a text: words, their characters, symbols, repeated lines, words in repeated windows of
three words; short and repetitive texts fail. Across documents: every line is normalised (case,
digits, blanks) and hashed, and the different documents of its host that have it are counted.
Lines above the host's limit are removed; a document that loses more than ``DEPLETED`` of its
characters is rejected.

Exact copies within a host are one document, as their text counts once: a host's page fetched a
thousand times makes none of its lines frequent. Rows are told apart by host and 128 bits of
text hash, never by id, so null and repeated ids are rows like others, and rows of equal host
and text get the same verdict. A null text is empty (no words: it fails the base rules); a null
host is a host of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import table

#: Base rules: least words, and the share of words in repeated windows of WINDOW words, per cent.
MIN_WORDS, WINDOW, REPEATED = 50, 3, 50
#: A line goes when more different documents of a host have it than LEAST and than SHARE of the host's.
LEAST, SHARE = 10, 0.02
#: Share of its characters that a document may lose.
DEPLETED = 0.5
BLANK, BLANKS, SYMBOLS = r"[\x20\x09-\x0D]+", " \t\n\x0b\x0c\r", "#*$%&|<>"
NOISE = r"[0-9\x20\x09-\x0D]+"
#: Parts into which rows of one hot line, or copies of one hot text, are split before a join.
SALT = 16


def named(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK), "")


def without(text: Column, drop: str) -> Column:
    for c in drop:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WINDOW words standing twice or more in the text, the first one included."""
    def covered(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = lambda s: F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
        starts = F.sort_array(F.transform(named(ordered, twice), lambda x: x["i"]))
        steps = lambda p: F.transform(p, lambda a, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - a, F.lit(WINDOW))))
        return F.aggregate(named(starts, steps), F.lit(0), lambda a, x: a + x)

    windows = lambda w: F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))))).otherwise(F.array().cast("array<bigint>"))
    count = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))
    return named(windows(words), count)


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")


def line_hash(line: Column) -> Column:
    """Of the line in lower case, every run of digits and blanks as one blank."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), NOISE, " ")))


def _keyed(docs: DataFrame, text_col: str, host_col: str) -> DataFrame:
    """The rows with __t (text), __host, __k1, __k2 (whose text it is: host and 128 bits)."""
    t, host = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(host_col).cast("string")
    return docs.withColumns({"__t": t, "__host": F.xxhash64(host.isNull(), host), "__k1": F.xxhash64(t), "__k2": F.xxhash64(F.lit(1), t)})


KEY = ["__host", "__k1", "__k2"]


def _frequent_lines(keyed: DataFrame, least: int, share: float) -> DataFrame:
    """KEY, h, chars: lines of different texts (their characters summed over the text) that more of the host's texts have than its limit."""
    line = lambda x: F.struct(line_hash(x).alias("h"), F.length(x).alias("chars"))
    texts = keyed.select(*KEY, F.transform(lines_of(F.col("__t")), line).alias("lines")).groupBy(*KEY).agg(F.any_value("lines").alias("lines"))
    lines = texts.select(*KEY, F.explode("lines").alias("x")).groupBy(*KEY, F.col("x.h").alias("h")).agg(F.sum("x.chars").alias("chars"))
    limits = texts.groupBy("__host").agg(F.greatest(F.lit(least), F.lit(share) * F.count(F.lit(1))).alias("limit"))
    held = lines.groupBy("__host", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    over = held.join(limits, "__host").filter(F.col("n") > F.col("limit")).select("__host", "h", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    return lines.withColumn("salt", F.pmod("__k1", F.lit(SALT)).cast("int")).join(over, ["__host", "h", "salt"]).drop("salt")


def _with_verdicts(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Left join by KEY; copies of one text are dealt over SALT parts."""
    spread = verdicts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return docs.withColumn("__salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALT)).cast("int")).join(spread, [*KEY, "__salt"], "left").drop("__salt")


def measures(text: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) of a text."""
    one = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).cast("long").alias("n_repeat_words"))
    again = lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")
    failed = lambda m: (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > REPEATED * m["n_words"])
    return named(named(word_list(text), one), lambda m: F.struct(
        m["n_words"], m["word_chars"], (F.length(text) - F.length(without(text, SYMBOLS))).cast("long").alias("n_symbols"),
        named(lines_of(text), again).alias("n_dup_lines"), m["n_repeat_words"], failed(m).alias("base_failed")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", least: int = LEAST, share: float = SHARE, depleted: float = DEPLETED) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_chars, base_failed, kept; a row for each row of ``docs``, whatever else its columns are called."""
    keyed = _keyed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(host_col).alias("host")), "text", "host")
    gone = _frequent_lines(keyed, least, share).groupBy(*KEY).agg(F.sum("chars").alias("removed_chars"))
    rows = _with_verdicts(keyed.select("doc_id", *KEY, F.length("__t").alias("n"), measures(F.col("__t")).alias("m")), gone)
    rows = rows.select("doc_id", "m.*", "n", F.coalesce("removed_chars", F.lit(0)).cast("long").alias("removed_chars"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("removed_chars") <= depleted * F.col("n"))).drop("n")


def clean(docs: DataFrame, text_col: str = "text", host_col: str = "source", least: int = LEAST, share: float = SHARE, depleted: float = DEPLETED) -> DataFrame:
    """The rows of documents that are kept, their frequent lines removed; columns as they were. Names that begin with ``__quality_`` are ours."""
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__quality_row"), F.col(text_col).alias("text"), F.col(host_col).alias("host"))
    keyed = _keyed(inner, "text", "host")
    gone = _frequent_lines(keyed, least, share).groupBy(*KEY).agg(F.collect_list("h").alias("hs"), F.sum("chars").alias("removed"))  # a text's own lines
    t = F.col("__t")
    rows = _with_verdicts(keyed.filter(~measures(t)["base_failed"]), gone).filter(F.coalesce("removed", F.lit(0)) <= depleted * F.length(t))
    left = F.array_join(F.filter(F.split(t, "\n"), lambda x: (F.trim(x, F.lit(BLANKS)) == "") | ~F.array_contains("hs", line_hash(x))), "\n")
    text = F.when(F.col("hs").isNull(), F.col("text")).otherwise(left)
    return rows.withColumn("__quality_text", text).select(*((F.col("__quality_text") if c == text_col else F.col("__quality_row")[c]).alias(c) for c in docs.columns))


def op13(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


SQL = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(t, '{BLANK}'), lambda x: x <> '') AS w FROM d),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
threes AS (SELECT doc_id, i, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, x, y, z FROM threes WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM threes JOIN twice USING (doc_id, x, y, z)) GROUP BY doc_id),
lines AS (SELECT doc_id, source, t, line, trim(regexp_replace(lower(line), '{NOISE}', ' ', 'g')) AS norm, length(line) AS chars
  FROM (SELECT *, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT source, greatest({LEAST}, {SHARE} * count(DISTINCT t)) AS most FROM d GROUP BY source),
frequent AS (SELECT l.source, norm FROM lines l JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source GROUP BY l.source, norm, most HAVING count(DISTINCT t) > most),
gone AS (SELECT doc_id, sum(chars) AS n FROM lines l JOIN frequent f ON l.source IS NOT DISTINCT FROM f.source AND l.norm = f.norm GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '{BLANK}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(gone.n, 0) AS BIGINT) AS removed_chars, length(t) AS n
  FROM d JOIN w USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT * EXCLUDE (n), n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words) AND removed_chars <= {DEPLETED} * n AS kept
FROM m
"""
