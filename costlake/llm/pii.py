"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust their score. DataFrame functions only.

Places are found without a Python function: ``split`` gives the text between the matches and
``regexp_extract_all`` the matches, both by the same scan, so running lengths give offsets in
code points. The patterns are written so that one pass over a text is linear: a run is taken
possessively and is entered only at its first character (or where the last match ended).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import table, texts

LOCAL = r"A-Za-z0-9._%+\-"
#: What each kind's scan looks for. Equal to the base patterns with their failing runs left out.
PATTERNS = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # 12 to 19 digits, each after at most one blank or hyphen; neither end can be carried on
    "card": r"(?<![0-9])(?<![0-9][ \-])[0-9](?:[ \-]?[0-9]){11,18}+(?![ \-]?[0-9])",
    "phone": r"\+[0-9][ ().0-9\-]+[0-9]",
    # added by the method: a bank account with its mod-97 check, a social security number announced by a word
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
#: A cheap sign without which no scan is made.
SIGN = {"email": "@", "phone": "+"}
#: Confidence before context, and words just before a span that raise or lower it. Fixed values.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.3}
RAISES = {
    "email": "e-?mail|mail|contact|write",
    "ip": r"\bip\b|address|host|server|login",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": r"phone|\btel|call|mobil|fax|ruf|appel|llam",
    "iban": "iban|account|konto|compte|cuenta|bank",
    "ssn": r"\bssn\b|social security|security n",
}
LOWERS = "version|release|chapter|section|invoice|order|article|isbn"
#: Characters before a span in which the words count, the gain or loss, and the score that added kinds need.
CONTEXT, STEP, ADDED_MIN = 48, 0.2, 0.5


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _chars(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(c: Column, i: Column) -> Column:
        n = c.cast("int")
        return F.when(i % 2 == 0, n).when(n > 4, n * 2 - 9).otherwise(n * 2)

    return F.aggregate(F.transform(_chars(F.reverse(digits)), value), F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes the mod-97 check (letters are 10 to 35, the first four come last)."""
    plain = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substring(plain, 5, 99), F.substring(plain, 1, 4))
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.filter(_chars(moved), lambda c: c.rlike("^[0-9A-Z]$")), F.lit(0), step) == 1


def valid(kind: str, m: Column) -> Column:
    """Whether a proposed match stands."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return (F.length(F.regexp_replace(m, " ", "")).between(15, 34)) & mod97(m)
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<start int, ord int, end int, kind string, score double>> of one kind, in order."""
    pattern = PATTERNS[kind]
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string,score:double>>")

    def take(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        near = F.lower(F.right(x["gap"], F.lit(CONTEXT)))
        score = F.lit(PRIOR[kind]) + F.when(near.rlike(RAISES[kind]), STEP).otherwise(0.0) - F.when(near.rlike(LOWERS), STEP).otherwise(0.0)
        ok = valid(kind, x["hit"])
        if kind not in BASE:
            ok = ok & (score >= ADDED_MIN)
        one = F.array(F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), end.alias("end"), F.lit(kind).alias("kind"), F.least(score, F.lit(1.0)).alias("score")))
        return F.struct(end.alias("at"), F.when(ok, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"))
    zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    spans = F.aggregate(pairs, zero, take, lambda acc: acc["out"])
    return F.when(F.contains(text, F.lit(SIGN[kind])) if kind in SIGN else text.rlike("[0-9]{2}|[0-9][.]"), spans).otherwise(empty)


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """The input with a column ``out``: all spans of the whole text by start, then kind.

    Null texts count as empty and have none. Repeated rows are searched each for itself.
    Other columns stay; an earlier column of that name is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(out, F.sort_array(F.concat(*(spans_of(whole, k) for k in KINDS))))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with every span of its text replaced by its kind, as ``[EMAIL]``; of overlapping spans the first counts, and what they cover goes."""
    def take(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = F.aggregate("__spans", zero, take, lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return find(docs, text, "__spans").withColumn(text, F.when(F.size("__spans") > 0, done).otherwise(F.col(text))).drop("__spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9(spark, sf_dir: str) -> DataFrame:
    found = find(texts(table(spark, sf_dir, "documents")))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("pii", lambda s: s["ord"] < len(BASE))
    return found.select("doc_id", *(count(k) for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"),
                        F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
