import hashlib

import numpy as np
import pytest

from tradeloom.llm import editprint
from tradeloom.llm.queries import op10_editprint, op10_nearprints


def plain_walk(text):
    """The sampled digits by one step after another."""
    points = np.array([ord(c) for c in text], np.uint32)
    codes = ((points * np.uint32(2654435761) >> np.uint32(16)) % np.uint32(255) + np.uint32(1)).tolist() + [0]
    at, digits, sampled = 0, [], editprint.SAMPLED.tolist()
    step = 0
    while len(digits) < len(sampled) and (at < len(text) or step <= sampled[len(digits)] < step):
        while len(digits) < len(sampled) and sampled[len(digits)] == step:
            digits.append(chr(editprint.SYMBOLS[len(digits)][codes[at]]))
        at += int(editprint.MOVES[step % editprint.PERIOD][codes[at]])
        step += 1
    return "".join(digits).rstrip(".")


TEXTS = ["", "a", "ab", "word " * 30, "é\U0001f600" * 77, "x" * 5000, "The quick brown fox. " * 700, "a", "1", "." * 40]


def test_walks_like_one_step_after_another():
    got = editprint.fingerprints(TEXTS)
    assert [g.rstrip(".") for g in got] == [plain_walk(t) for t in TEXTS]
    assert editprint.fingerprints(TEXTS[::-1]) == got[::-1]
    assert editprint.fingerprints([]) == []


def test_samples_lie_in_their_octaves():
    for o in range(1, 12):
        own = editprint.SAMPLED[o * editprint.DIGITS:(o + 1) * editprint.DIGITS]
        assert len(set(own)) == editprint.DIGITS and own.min() >= 64 << (o - 1) and own.max() < 64 << o


def test_a_few_edits_stay_near_and_other_texts_do_not():
    random = np.random.default_rng(0)
    letters = list("abcdefghijklmnopqrstuvwxyz   ")
    one, other = ("".join(random.choice(letters, 4000)) for _ in range(2))
    changed = one[:1500] + "Z" + one[1500:2000] + one[2003:]
    a, b, c = editprint.fingerprints([one, changed, other])
    assert editprint.likeness([a], [b])[0] > 0.6 > 0.2 > editprint.likeness([a], [c])[0]
    assert editprint.likeness([a, "", ""], [a, "", a]).tolist() == [1, 1, 0]


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        changed = text[:len(text) - q] + following[:q]
        own, after, near = editprint.fingerprints([text, changed, following])
        out.append((key, len(text), hashlib.sha256(changed.encode()).hexdigest(), own, after,
                    editprint.likeness([own], [after])[0], editprint.likeness([own], [near])[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("buffer", [50, 12_000_000])
def test_documents_like_brute_force(spark, monkeypatch, buffer):
    monkeypatch.setattr(editprint, "BUFFER", buffer)
    rows = [(i * 7 % 101 - 20, f"text number {i} " * (1 + i % 9)) for i in range(101)] + [(None, "no key"), (None, None), (3, "again"), (3, "again"), (500, "last one é")]
    df = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "key long, text string, place int, own string")
    got = sorted((tuple(r) for r in editprint.fingerprint_documents(df, "key", "text").collect()), key=str)
    assert got == plain(rows)


def test_one_document_and_none(spark):
    df = spark.createDataFrame([(1, "abcdefgh")], "doc_id int, text string")
    out = editprint.fingerprint_documents(df, "doc_id", "text")
    assert out.schema["doc_id"].dataType.simpleString() == "int"
    assert [tuple(r) for r in out.collect()] == plain([(1, "abcdefgh")])
    assert editprint.fingerprint_documents(df.limit(0), "doc_id", "text").count() == 0


def test_near_pairs(spark):
    random = np.random.default_rng(1)
    words = ["".join(random.choice(list("abcdefghij"), 5)) for _ in range(500)]
    texts = [" ".join(random.choice(words, 300)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t[:-30] + "changed at its very end") for i, t in enumerate(texts)] + [(200, texts[0])]
    prints = editprint.fingerprints([t for _, t in rows])
    df = spark.createDataFrame([(k, p, 1) for (k, _), p in zip(rows, prints)] + [(None, prints[0], 1), (300, "", 1), (301, None, 1)], "id long, print string, near int")
    got = {(r["key"], r["near"]) for r in editprint.near_pairs(df, "id", "print", 0.7).collect()}
    assert {(100 + i, i) for i in range(20)} | {(200, 0)} <= got
    assert all(k % 100 == n or (k, n) == (200, 0) for k, n in got)
    assert editprint.near_pairs(df.limit(0), "id", "print").count() == 0


def test_query(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op10_editprint(spark, sf).collect()), key=str)
    assert [g[:5] for g in got] == [p[:5] for p in plain(docs)]
    assert np.allclose([g[5:] for g in got], [p[5:] for p in plain(docs)])
    near, following = np.array([g[5] for g in got if g[1] > 400]), np.array([g[6] for g in got if g[1] > 400])
    assert abs(np.median(near) - 0.75) < 0.1 and np.median(following) < 0.15


def varied(base):
    """A print with one digit of every band of its last two octaves changed, except the last band."""
    return "".join("123456789abcdef0"[int(c, 16)] if 64 <= i < 124 and i % 4 == 0 else c for i, c in enumerate(base))


def grouped(pairs, keys):
    root = {k: k for k in keys}

    def up(k):
        return k if root[k] == k else up(root[k])

    for a, b in pairs:
        a, b = sorted((up(a), up(b)))
        root[b] = a
    return {k: up(k) for k in keys}


def all_pairs(prints):
    """Pairs that share a band of the last two octaves and are alike, each against each."""
    digits, out = editprint.DIGITS, []

    def bands(p):
        top = max(len(p) // digits - 1, 0)
        return {(o, i, p[o * digits + i:][:4]) for o in {max(top - 1, 0), top} for i in range(0, digits, 4)}

    own = [bands(p) for p in prints]
    for i in range(len(prints)):
        for j in range(i):
            if own[i] & own[j] and editprint.likeness([prints[i]], [prints[j]])[0] >= 0.8:
                out.append((i, j))
    return out


def test_near_pairs_behind_unrelated_heads(spark, monkeypatch):
    """All prints share a band, its first members are like nothing else."""
    monkeypatch.setattr(editprint, "BLOCK", 16)
    random = np.random.default_rng(5)
    bases = ["".join(random.choice(list("0123456789abcdef"), 124)) + "aaaa" for _ in range(40)]
    prints = [*bases, *map(varied, bases[10:])]
    df = spark.createDataFrame(list(enumerate(prints)), "id long, print string")
    want = grouped(all_pairs(prints), range(len(prints)))
    got = editprint.near_pairs(df, "id", "print").collect()
    assert all(r["likeness"] == editprint.likeness([prints[r["key"]]], [prints[r["near"]]])[0] >= 0.8 and r["key"] > r["near"] for r in got)
    assert grouped([(r["key"], r["near"]) for r in got], range(len(prints))) == want and len(set(want.values())) == 40


def test_groups_of_all_documents(spark, small_sf):
    got = {r["doc_id"]: r["component_id"] for r in op10_nearprints(spark, small_sf).collect()}
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{small_sf}/documents.parquet").select("doc_id", "text").collect())
    ids = [i for i, _ in docs]
    pairs = all_pairs(editprint.fingerprints([t or "" for _, t in docs]))
    assert got == grouped([(ids[a], ids[b]) for a, b in pairs], ids)
