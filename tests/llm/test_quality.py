"""Counts and verdicts against plain Python."""

import re
from collections import Counter

from costlake.llm import quality

SCHEMA = "doc_id long, text string, source string, n int, h long, __salt int"
LONG = " ".join(f"word{i}" for i in range(60))


def brute(rows, least, share, depleted):
    texts = {(s, t or "") for _, t, s in rows}
    norm = lambda x: re.sub(r"[0-9 \t-\r]+", " ", x.lower()).strip(" ")
    real = lambda t: [x for x in t.split("\n") if re.search(r"[^ \t-\r]", x)]
    hosts, held = Counter(s for s, _ in texts), Counter()
    for s, t in texts:
        held.update({(s, norm(x)) for x in real(t)})
    out = []
    for d, t, s in rows:
        t = t or ""
        w, lines = re.findall(r"[^ \t-\r]+", t), real(t)
        threes = Counter(zip(w, w[1:], w[2:]))
        again = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if threes[x] > 1 for k in range(3)}
        gone = sum(len(x) for x in lines if held[s, norm(x)] > max(least, share * hosts[s]))
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        out.append((d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), gone, failed, not failed and gone <= depleted * len(t)))
    return sorted(out, key=repr)


def listed(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_chars", "base_failed", "kept")) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, 0, 1, 2) for d, t, s in rows], SCHEMA)


def cases():
    foot = " ".join(f"foot{i}" for i in range(70))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t \x0b", None), (4, LONG, None), (4, LONG, "a"), (None, LONG, "a"), (5, "a b c a b c a b", "a")]
    rows += [(6, "x " * 80, "b"), (7, f"#1 $2\n#1 $2\n\n#1 $2 \n{LONG} é𝒳 <&>|%*", "b"), (8, "one two three " + LONG + " one two three one two three", "b")]
    rows += [(20 + i, f"{LONG} {i}x\n{foot}  {i}\n", "hot") for i in range(9)]  # one line, told apart by digits and blanks only
    rows += [(40 + i, f"{LONG}\n{foot}", "copies") for i in range(9)]  # one text: its lines stand in one document
    rows += [(60 + i, f"{foot.upper()} {i}\n{'abcdefghi'[i]}{LONG} {LONG[::-1]} {LONG.upper()}", None) for i in range(9)]
    return rows


def test_against_plain_python(spark):
    rows = cases()
    for least, share, depleted in ((3, 0.0, 0.4), (3, 0.9, 0.5), (0, 0.1, 0.9)):
        assert listed(quality.judge(frame(spark, rows), least=least, share=share, depleted=depleted)) == brute(rows, least, share, depleted)


def test_lines_are_removed_and_columns_stay(spark):
    rows = cases()
    out = quality.clean(frame(spark, rows), least=3, share=0.0, depleted=0.6)
    assert out.columns == ["doc_id", "text", "source", "n", "h", "__salt"]
    kept = {r[0] for r in brute(rows, 3, 0.0, 0.6) if r[-1]}
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert set(got) == kept and {60, 61, 40, 4, None} <= kept
    assert got[60].startswith("aword0 word1") and got[40] == next(t for d, t, _ in rows if d == 40)
    assert quality.clean(frame(spark, rows), least=3, share=0.0, depleted=0.3).filter("source = 'hot'").count() == 0


def test_whole_table_and_empty_table(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert listed(quality.op13(spark, "/root/testdata/sf0.001")) == brute(rows, quality.LEAST, quality.SHARE, quality.DEPLETED)
    empty = frame(spark, [])
    assert quality.judge(empty).count() == 0 and quality.clean(empty).count() == 0


def test_no_python_in_plan(spark):
    plan = quality.op13(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
