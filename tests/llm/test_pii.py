import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from convoloom.llm.pii import pii_spans

from .helpers import EDGES, edge_docs, empty_docs

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        x = int(c) * (1 + i % 2)
        total += x // 10 + x % 10
    return total % 10 == 0


def fine(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        out += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if fine(kind, m[0])]
    return sorted(out)


def check(spark, texts):
    got = {r.doc_id: r for r in pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in want)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), (t, want, got[i])
        assert [got[i][f"n_{k}"] for k in BASE] == [sum(w[3] == k for w in want) for k in BASE]
        assert [s for s in got[i].spans.split(",") if s and s.split(":")[0] in BASE] == [f"{k}:{a}:{b}" for a, _, b, k in want]
    return got


def test_cases(spark):
    texts = [
        "mail a.b@c.de, x@y, a@b.c@d.e and a@b.cd%x@y.z", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.4 12345.1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 49927398716000",
        "+49 (30) 123-456-78 or +1 2 or +12345678901234567", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "😀 a@b.co 😀 +4930123456789", "é1.2.3.4é", None, "", "+1((((", "-" * 300 + "1" * 5000 + " " + "a" * 20000 + "@" + "b." * 4000 + "c",
    ]
    check(spark, texts)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab@.+-%0123456789 ()é\n", max_size=60), min_size=60, max_size=60))
def test_random(spark, texts):
    check(spark, texts)


def test_added_kinds(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 ok", "GB82 WEST 1234 5698 7654 33", "social security number 078-05-1120", "order 078-05-1120"]
    got = {r.doc_id: r for r in pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got[0].spans == "iban:5:32" and "iban" not in got[1].spans and got[2].spans == "ssn:23:34" and got[3].spans == ""
    assert got[0].scores == "iban:5:0.95"


def test_edges(spark):
    got = pii_spans(edge_docs(spark)).collect()
    assert len(got) == len(EDGES) and all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got)
    assert pii_spans(empty_docs(spark)).count() == 0


def test_no_python_in_plan(spark):
    plan = pii_spans(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_ibans_end_where_their_country_says(spark):
    good = {
        "DE89370400440532013000 The bank": "iban:0:22", "GB82WEST12345698765432 Thanks": "iban:0:22", "pay GB82 WEST 1234 5698 7654 32 EUR now": "iban:4:31",
        "GB82 WEST 1234 5698 7654 32 USD account": "iban:0:27", "NO93 8601 1117 947 CHF": "iban:0:18", "(FR14 2004 1010 0505 0001 3M02 606)": "iban:1:34",
    }
    bad = ["DE8937040044053201300", "DE893704004405320130001", "DE90370400440532013000", "ZZ89370400440532013000", "xDE89370400440532013000"]
    texts = [*good, *bad]
    got = {r.doc_id: r.spans for r in pii_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert [s for s in got[i].split(",") if s.startswith("iban")] == ([good[t]] if t in good else []), (t, got[i])


def test_many_matches_take_linear_time(spark):
    from time import monotonic

    n = 20_000
    text = " ".join(f"write a{i}@b.co" for i in range(n))
    began = monotonic()
    got = check(spark, [text, "a@b.co " * 63, "a@b.co " * 64, "a@b.co " * 65, "a@b.co " * 129])
    assert got[0].n_email == n and got[0].scores.count("email") == n and "1.05" in got[0].scores
    assert monotonic() - began < 30
