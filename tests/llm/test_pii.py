"""Spans against the base patterns run one by one in Python."""

import hashlib
import random
import re

import pytest

from costlake.llm import pii

RAW = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        n = int(c) * (1 + i % 2)
        s += n - 9 * (n > 9)
    return s % 10 == 0


def brute(text):
    out = []
    for k, (kind, p) in enumerate(RAW.items()):
        for m in re.finditer(p, text or "", re.A):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def cases():
    rng = random.Random(5)
    out = ["", None, "a@b.c_d@e.f", "x@@y.z a@b@c.d.", "1.2.3.4.5 001.02.3.255 1.2.3.256 12.34.5", "4111 1111 1111 1111 5", "4111-1111-1111-1111", "é 4111111111111111é", "+1 (988) 555-2485 +12 +1 2 3 4 5 6 7 8 9 +491234567890123456",
           "iban DE89 3704 0044 0532 0130 00.", "ssn 123-45-6789 and 123-45-6780", "𝒳 a.b@c-d.example.com.", "a" * 30_000 + "@" + "b" * 30_000, "1" * 40_000 + " " + "1 " * 20_000, "1.2.3.4 " * 300]
    for _ in range(600):
        out.append("".join(rng.choice(["1", "23", "@", ".", "-", " ", "+", "a", "b.c", "(", ")", "é", "4111111111111111", "_", "\n"]) for _ in range(rng.randint(1, 40))))
    return out


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, "x") for i, t in enumerate(cases())]
    df = pii.find(spark.createDataFrame(rows, "doc_id long, text string, pii string"))
    return {r["doc_id"]: r["pii"] for r in df.collect()}


def test_base_spans_as_brute_force(found):
    for i, t in enumerate(cases()):
        mine = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in found[i] if s["kind"] in RAW)
        assert mine == brute(t), (i, t[:80] if t else t)


def test_added_kinds(found):
    at = {t: i for i, t in enumerate(cases())}
    assert [s["kind"] for s in found[at["iban DE89 3704 0044 0532 0130 00."]] if s["kind"] == "iban"] == ["iban"]
    # the second is near the first one's end, not announced by its own word
    assert [s["start"] for s in found[at["ssn 123-45-6789 and 123-45-6780"]] if s["kind"] == "ssn"] == [4]


def test_redact_null_empty_repeated(spark):
    rows = [(1, "mail a@b.cc, ip 1.2.3.4!", 0), (1, "mail a@b.cc, ip 1.2.3.4!", 0), (2, None, 0), (None, "", 0)]
    done = pii.redact(spark.createDataFrame(rows, "doc_id long, text string, pii int"))
    assert done.columns == ["doc_id", "text", "pii"]
    out = done.select("doc_id", "text").collect()
    assert sorted([tuple(r) for r in out], key=str) == sorted([(1, "mail [EMAIL], ip [IP]!")] * 2 + [(2, None), (None, "")], key=str)


def test_query_on_small_table(spark, tmp_path):
    spark.createDataFrame([(7, "x a@b.cc", "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    r = pii.op9(spark, str(tmp_path)).collect()[0]
    assert (r["n_email"], r["n_ip"], r["spans"]) == (1, 0, "email:2:8")
    assert r["base_sha256"] == hashlib.sha256(b"email:2:8").hexdigest()


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
