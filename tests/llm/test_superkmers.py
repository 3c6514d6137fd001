import random
import re
from collections import defaultdict

import numpy as np
import pytest

from oracle_compare import connect
from tradeloom.llm import superkmers
from tradeloom.llm.queries import op11_superkmers

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, window=13):
    """(key, kept, n_words, n_removed) by a dictionary of all windows."""
    held = [(key, SPACES.findall(text or "")) for key, text in docs]
    least = {}
    for key, words in held:
        if key is not None:
            for i in range(len(words) - window + 1):
                w = tuple(words[i:i + window])
                least[w] = min(least.get(w, key), key)
    out = []
    for key, words in held:
        gone = set()
        if key is not None:
            for i in range(len(words) - window + 1):
                if least[tuple(words[i:i + window])] < key:
                    gone.update(range(i, i + window))
        out.append((key, " ".join(w for i, w in enumerate(words) if i not in gone), len(words), len(gone)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def passages(seed, n=120):
    """Documents of few words, with passages, lines and whole texts that others have too."""
    rng = random.Random(seed)
    shared = [" ".join(rng.choice("abcdefgh") + str(rng.randrange(6)) for _ in range(rng.randrange(5, 60))) for _ in range(8)]
    docs = []
    for key in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choice("xyz") + str(rng.randrange(300)) for _ in range(rng.randrange(30)))
                 for _ in range(rng.randrange(5))]
        docs.append((key, rng.choice([" ", "\n", " \t "]).join(parts)))
    return docs + [(n + i, docs[rng.randrange(n)][1]) for i in range(20)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("window", [2, 5, 13])
def test_against_all_windows(spark, seed, window):
    docs = passages(seed)
    random.Random(seed).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert got(superkmers.drop_repeats(df, "doc_id", "text", window)) == plain(docs, window)


def test_hot_cells_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "HOT_LEAST", 3)
    monkeypatch.setattr(superkmers, "HOT", 0)
    docs = passages(7)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    known = df.select("text")
    assert len(superkmers.hot_cells(known, 256, 13))
    assert got(superkmers.drop_repeats(df, "doc_id", "text")) == plain(docs)


def test_a_hot_line_is_dealt_over_buckets(spark, monkeypatch):
    """A line in every document, each time in other words: its windows go to many buckets, none of them with most."""
    monkeypatch.setattr(superkmers, "HOT_LEAST", 200)
    rng = random.Random(5)
    line = " ".join(f"line{i}" for i in range(12))
    other = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(20))
    docs = [(key, f"{other()} {line} {other()}") for key in range(2000)]
    df = spark.createDataFrame(docs, "key long, text string")
    cells = superkmers.CELLS * 16
    hot = superkmers.hot_cells(df, cells, 13)
    loads = {}
    for name, cut in (("hot", hot), ("plain", hot[:0])):
        dealt = superkmers.deal(df, 16, cells, spark.sparkContext.broadcast(cut), 13).collect()
        sizes = defaultdict(int)
        for row in dealt:
            sizes[row["bucket"]] += len(superkmers._opened(row["payload"])[0])
        loads[name] = max(sizes.values()) / sum(sizes.values())
    assert loads["hot"] < 0.1 < loads["plain"]


def test_odd_rows(spark):
    copy = " ".join(f"w{i}" for i in range(20))
    docs = [(5, copy), (3, copy), (3, copy + " more words"), (None, copy), (None, copy), (4, None), (6, ""), (7, " \n\t "),
            (8, "short text"), (9, " ".join(["x"] * 30)), (10, "same " * 5000), (11, "same " * 40), (-2, "end " + copy)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS kept", "text AS key", "2 AS n_words")
    out = superkmers.drop_repeats(df, "doc_id", "text")
    assert out.columns == ["doc_id", "kept", "n_words", "n_removed"]
    assert got(out) == plain(docs)
    assert got(superkmers.drop_repeats(df.where("false"), "doc_id", "text")) == []


def test_keys_named_like_outputs(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "kept long, text string")
    assert superkmers.drop_repeats(df, "kept", "text").columns == ["kept", "kept_", "n_words", "n_removed"]


def test_super_kmers_hold_every_window_once():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["a", "b", "c", "dd"], n)) for n in (0, 5, 13, 14, 200, 12)] + ["z " * 500]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *map(len, texts)])
    found = superkmers.words(np.frombuffer(data, np.uint8), offsets, letters=superkmers.SAME)
    pieces = superkmers.super_kmers(found)
    held = [(r, w + k) for r, w, n in zip(pieces.row.tolist(), pieces.word.tolist(), pieces.size.tolist()) for k in range(n)]
    expected = [(r, int(found.bounds[r]) + k) for r, t in enumerate(texts) for k in range(max(0, len(t.split()) - 12))]
    assert held == expected
    assert pieces.size.max() <= superkmers.MOST_WINDOWS


def test_query_against_all_windows(spark, sf):
    import hashlib

    docs = connect(sf).sql("SELECT doc_id, text FROM documents").fetchall()
    wanted = [(k, w, r, hashlib.sha256(kept.encode()).hexdigest()) for k, kept, w, r in plain(docs)]
    assert sorted(map(tuple, op11_superkmers(spark, sf).collect())) == sorted(wanted)
