import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tradeloom.llm import pii
from tradeloom.llm.queries import op8_pii

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if fits:
                out.append((kind, m.start(), m.end()))
    return out


TEXTS = [
    None, "", "plain words", "a@b.c", "a@b.c_d@e.f", "foo@bar baz@q.com", "x@y..z u@v.w.", "..@a.b.c-", "a@a@a.b", "éa@b.cé \U0001f600 x.y@z.w",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.00.0.01", "9.1.2.3.4", "1..2.3.4.5", "12345.6.7.8.9 999999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111x4111111111111111", "4111  1111111111111", "41111111111111112 1", "0000000000000000000", "0" * 20,
    "+1 (017) 555-7713 and +123", "+1 +1 2345678 +12345678", "+1" + " " * 500 + "9 +1(((((", "+1234567890123456", "++12345678.",
    "@" * 300 + "a@b.co", "a" * 20_000 + "@" + "b" * 20_000 + ".c", "7 " * 40_000 + "a@b.c", "1.2.3.4\n+1 (017) 555-7713\njo@mail.example.com\n4111111111111111",
    "mail a@b.c." + "x" * 50 + " ip 10.0.0.1, +44 20 7946 0958; 4012888888881881!",
]


def found(spark, rows):
    df = spark.createDataFrame(rows, "id long, text string, base string, content int")
    return pii.find(df, "id", "text").select("id", "base", pii.span_text(F.col("spans")).alias("spans")).collect()


def test_forms_like_brute_force(spark):
    got = {r["id"]: [(pii.KINDS[s["kind"]], s["start"], s["end"]) for s in r["base"]] for r in found(spark, [(i, t, "b", 1) for i, t in enumerate(TEXTS)])}
    order = {k: i for i, k in enumerate(FORMS)}
    for i, text in enumerate(TEXTS):
        assert got[i] == sorted(plain(text), key=lambda s: (order[s[0]], s[1])), text and text[:80]


def test_contexts_find_unseen_identifiers(spark):
    """Numbers without a plus are phones where only phones are named so; others are not."""
    rows = [(i, f"please call us on +1 (017) 555-{1000 + i} today or write", "b", 1) for i in range(40)]
    rows += [(100 + i, f"please call us on 017 555-0{200 + i}x today or write", "b", 1) for i in range(3)]
    rows += [(200 + i, f"the parcel of weight 90{2000 + i} grams was sent", "b", 1) for i in range(20)]
    rows = [(i, t.replace("017 555-0", "0175550-0"), b, c) for i, t, b, c in rows]
    got = {r["id"]: r["spans"] for r in found(spark, rows)}
    for i, text, _, _ in rows:
        if i < 100:
            start = text.index("+1")
            assert got[i] == f"phone:{start}:{text.index(' today')}"
        elif i < 200:
            assert got[i] == f"phone:{text.index('0175550')}:{text.index(' today')}"
        else:
            assert got[i] == ""


def test_common_contexts_of_mixed_strings_find_nothing(spark):
    rows = [(i, f"it is of the +1 (017) 555-{1000 + i} and", "b", 1) for i in range(30)]
    rows += [(100 + i, f"it is of the 30{1000 + i}99 and", "b", 1) for i in range(30)]
    assert all(r["spans"] == "" for r in found(spark, rows) if r["id"] >= 100)


def test_repeated_rows_null_keys_and_empty(spark):
    rows = [(1, "a@b.c", "b", 1), (1, "a@b.c", "b", 1), (1, "1.1.1.1", "b", 1), (None, "a@b.c", "b", 1), (None, None, "b", 1)]
    assert sorted((r["id"] or 0, r["spans"]) for r in found(spark, rows)) == [
        (0, ""), (0, "email:0:5"), (1, "email:0:5"), (1, "email:0:5"), (1, "ip:0:7")]
    assert found(spark, []) == []


def test_mask(spark):
    rows = [(1, "x a@b.c y 1.2.3.4", 5, "k"), (2, None, 6, None), (None, "", 7, "k"), (4, "+x 4111111111111111", 8, "k"), (4, "\U0001f600 a@b.c", 9, "k")]
    df = spark.createDataFrame(rows, "key long, text string, content int, base string")
    out = pii.mask(df, "key", "text")
    assert out.columns == df.columns
    got = {r["content"]: (r["key"], r["text"], r["base"]) for r in out.collect()}
    assert got == {5: (1, "x <EMAIL> y <IP>", "k"), 6: (2, None, None), 7: (None, "", "k"), 8: (4, "+x <CARD>", "k"), 9: (4, "\U0001f600 <EMAIL>", "k")}


def test_mask_of_discoveries(spark, monkeypatch):
    rows = [(i, f"please call us on +1 (017) 555-{1000 + i} today") for i in range(40)] + [(99, "please call us on 0175550-0200x today")]
    df = spark.createDataFrame(rows, "id long, text string")
    for most in (10, 0):
        monkeypatch.setattr(pii, "BROADCAST_ROWS", most)
        assert {r["text"] for r in pii.mask(df, "id", "text").collect()} == {"please call us on <PHONE> today"}


def test_query(spark, sf):
    got = {r["doc_id"]: r for r in op8_pii(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        spans, r = plain(d["text"]), got[d["doc_id"]]
        counts = defaultdict(int)
        for kind, _, _ in spans:
            counts[kind] += 1
        assert [r[f"n_{k}"] for k in FORMS] == [counts[k] for k in FORMS]
        joined = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(filter(None, r["spans"].split(",")))
