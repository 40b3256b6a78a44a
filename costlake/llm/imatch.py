"""Document fingerprints by I-Match: terms within a band of inverse document frequency, sorted and distinct, hashed over several randomised lexicon subsets. DataFrame functions only.

The lexicon is every term that stands in ``BAND`` of the documents; a text of m distinct
terms on average bounds it by m / BAND[0] terms, whatever the corpus, and it is looked up in a
bit table of fixed size by the terms' hashes (a strange term meets a set bit seldom; it then
counts as a lexicon term in every text alike). A subset holds one in SUBSETS of the lexicon;
long texts use sparser subsets: level n keeps one term in 2^n, and a fingerprint has LEVELS
levels from the one that leaves about a term for each subset.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import table, task_count, texts

BAND = (0.005, 0.25)
SUBSETS, LEVELS = 32, 3
NOT_TERM = r"[^\p{L}\p{N}]+"
#: What a subset without terms shows.
NONE = "-"


def terms(text: Column) -> Column:
    """Hashes of the distinct terms of a text."""
    words = F.filter(F.split(F.lower(text), NOT_TERM), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, text: str = "text") -> list[int]:
    """Hashes of the terms in the band. Counted over all documents; the terms found are bounded (see above)."""
    held = docs.select(F.explode(terms(F.coalesce(F.col(text), F.lit("")))).alias("h"))
    n = docs.count()
    low, high = max(1.0, BAND[0] * n), max(1.0, BAND[1] * n)
    inside = held.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df").between(low, high))
    return sorted(r["h"] for r in inside.select("h").collect())


def _table(values: list) -> Column:
    kind = "array<array<bigint>>" if values and isinstance(values[0], list) else "array<bigint>"
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), kind)


def slots(hashes: list[int]) -> list[list[int]]:
    """The hashes dealt into as many slots, at least one."""
    out: list[list[int]] = [[] for _ in range(max(1, len(hashes)))]
    for h in hashes:
        out[h % len(out)].append(h)
    return out


def sketch(text: Column, lex: list[list[int]]) -> Column:
    """struct(level, cells): for each of LEVELS levels from ``level``, a hash for each subset. A text without lexicon terms uses all its terms. ``lex``: the lexicon's slots."""
    listed = lambda h: F.array_contains(F.get(_table(lex), F.pmod(h, F.lit(len(lex))).cast("int")), h)
    subset = lambda h: F.pmod(F.shiftright(h, 24), F.lit(SUBSETS))
    deep = lambda h, n: F.pmod(F.shiftright(h, 32), n) == 0

    def of(all_terms: Column) -> Column:
        inside = F.filter(all_terms, listed)
        return F.array_sort(F.when(F.size(inside) > 0, inside).otherwise(all_terms))

    def cells(kept: Column, level: Column) -> Column:
        one = lambda few: F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda g: _cell(F.filter(few, lambda h: subset(h) == g)))
        at = lambda d: F.filter(kept, lambda h: deep(h, F.pow(F.lit(2.0), level + d).cast("bigint")))
        return F.flatten(F.transform(F.array(*(at(d) for d in range(LEVELS))), one))

    kept = F.transform(F.array(text), lambda t: of(terms(t)))  # evaluated once, named below
    level = lambda k: F.greatest(F.lit(0), F.floor(F.log2(F.greatest(F.size(k), F.lit(1)) / SUBSETS)).cast("int"))
    return F.transform(kept, lambda k: F.struct(level(k).alias("level"), cells(k, level(k)).alias("cells")))[0]


def _cell(few: Column) -> Column:
    return F.when(F.size(few) > 0, F.right(F.hex(F.xxhash64(few)), F.lit(6))).otherwise(F.lit(NONE))


def fingerprint(s: Column) -> Column:
    return F.concat(s["level"].cast("string"), F.lit(":"), F.array_join(s["cells"], "."))


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets used by either that hash alike, over the levels that both have; 1 for equal sketches, 0 without a common level."""
    down = lambda x, y: F.greatest(y["level"] - x["level"], F.lit(0)) * SUBSETS
    n = F.greatest(F.lit(LEVELS * SUBSETS) - F.abs(a["level"] - b["level"]) * SUBSETS, F.lit(0))
    pairs = F.zip_with(F.slice(a["cells"], down(a, b) + 1, n), F.slice(b["cells"], down(b, a) + 1, n), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    same = F.size(F.filter(pairs, lambda p: (p["x"] == p["y"]) & (p["x"] != NONE)))
    used = F.size(F.filter(pairs, lambda p: (p["x"] != NONE) | (p["y"] != NONE)))
    return F.when((a["level"] == b["level"]) & (a["cells"] == b["cells"]), 1.0).when(used == 0, 0.0).otherwise(same / used)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text by ascending doc_id (repeated ids by their texts' hashes; null ids first), bucket, h and edge.

    Ids are cut into ranges; a range also gets the first row of the range after it (of the
    first range, for the last), marked ``edge``, so no range waits for another.
    """
    rows = texts(docs).select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("edge", F.lit(False))
    n = 2 * task_count(docs.sparkSession)
    cuts = sorted({int(c) for c in rows.approxQuantile("doc_id", [i / n for i in range(1, n)], 0.001)})
    bucket = F.size(F.filter(_table(cuts), lambda c: c <= F.col("doc_id")))  # one literal, however many ranges; a null id: the first
    rows = rows.withColumn("bucket", bucket)
    firsts = sorted(rows.groupBy("bucket").agg(F.min_by(F.struct("doc_id", "h"), F.struct("doc_id", "h")).alias("k")).collect())  # one row a range
    ends = [(b, *firsts[(i + 1) % len(firsts)]["k"]) for i, (b, _) in enumerate(firsts)]
    after = docs.sparkSession.createDataFrame(ends, "bucket int, doc_id long, h long")
    after = F.broadcast(after.withColumnsRenamed({"doc_id": "d", "h": "k"}))  # as many rows as ranges
    extra = rows.drop("bucket", "edge").join(after, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("k"))).drop("d", "k").withColumn("edge", F.lit(True))
    both = rows.unionByName(extra)
    order = Window.partitionBy("bucket").orderBy(F.col("edge"), F.col("doc_id").asc_nulls_first(), "h")
    return both.withColumn("next_text", F.lead("text").over(order))


def compare(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    Edited: the last half of a text (rounded down, code points) replaced by the first as many
    of the next document's. A null text is empty. One document alone is its own next. Repeated
    rows stay, each with its next in order.
    """
    lex = slots(lexicon(texts(docs)))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = with_next(docs).withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)))
    rows = rows.select("bucket", "edge", "doc_id", "h", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited"), 256).alias("edited_sha256"), sketch(F.col("text"), lex).alias("own"), sketch(F.col("edited"), lex).alias("changed"))
    order = Window.partitionBy("bucket").orderBy(F.col("edge"), F.col("doc_id").asc_nulls_first(), "h")
    rows = rows.withColumn("after", F.lead("own").over(order)).filter(~F.col("edge"))
    own, changed, after = F.col("own"), F.col("changed"), F.col("after")
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(own).alias("fingerprint"), fingerprint(changed).alias("edited_fingerprint"), likeness(own, changed).alias("near_edited"), likeness(own, after).alias("near_next"))


def op7(spark, sf_dir: str) -> DataFrame:
    return compare(table(spark, sf_dir, "documents"))
