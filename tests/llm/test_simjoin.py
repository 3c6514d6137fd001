import random
import re

import numpy as np
import pytest

from tradeloom.llm import simjoin
from tradeloom.llm.components import components
from tradeloom.llm.queries import op9_simjoin

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text, width):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i:i + width]) for i in range(len(found) - width + 1)) or frozenset([tuple(found)])


def plain(rows, width, percent):
    sets = [tokens(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    having = {}
    for i, s in enumerate(sets):
        for t in s:
            having.setdefault(t, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for t in s for j in having[t] if j > i}:
            shared = len(s & sets[j])
            if top(i) != top(j) and 100 * shared >= percent * (len(s) + len(sets[j]) - shared):
                root[top(j)] = top(i)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(least.get(top(i), key), key)
    return sorted((-1 if k is None else k, len(sets[i]), least.get(top(i)) if least.get(top(i)) is not None else -1) for i, (k, _) in enumerate(rows))


def joined(spark, rows, width, percent):
    df = spark.createDataFrame([(k, t, 3) for k, t in rows], "id long, text string, class int")
    out = simjoin.join_groups(df, "id", "text", width, percent)
    assert out.columns == ["id", "n_shingles", "component_id"]
    return sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in out.collect())


def corpus(seed, words, docs, copies):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passage = " ".join(pick.choice(vocabulary) for _ in range(60))
    rows = []
    for d in range(docs):
        text = [pick.choice(vocabulary) for _ in range(pick.choice([1, 3, 5, 8, 30, 120]))]
        if pick.random() < 0.3:
            text += passage.split()
        rows.append(" ".join(text))
        for _ in range(pick.choice([0, 0, copies])):
            edited = list(text)
            for _ in range(pick.choice([0, 1, 1, 2, 5])):
                at = pick.randrange(len(edited))
                edited[at:at + 1] = pick.choice([[], [pick.choice(vocabulary)], [edited[at], "new"]])
                edited = edited or ["left"]
            rows.append(pick.choice([" ", "\t", "\n"]).join(edited).upper() if pick.random() < 0.2 else " ".join(edited))
    pick.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed,words,width,percent", [(1, 400, 4, 85), (2, 30, 2, 80), (3, 8, 3, 60), (4, 2000, 5, 80)])
def test_like_brute_force(spark, seed, words, width, percent):
    rows = corpus(seed, words, 60, 6)
    assert joined(spark, rows, width, percent) == plain(rows, width, percent)


@pytest.mark.parametrize("seed,words,width,percent", [(5, 300, 4, 85), (6, 12, 3, 70)])
def test_like_brute_force_where_all_is_frequent(spark, monkeypatch, seed, words, width, percent):
    """With every token frequent, signatures are pairs alone."""
    made = simjoin.frequencies

    def all_frequent(described):
        freq = made(described)
        freq.frequent[:] = True
        return freq

    monkeypatch.setattr(simjoin, "frequencies", all_frequent)
    rows = corpus(seed, words, 60, 6)
    assert joined(spark, rows, width, percent) == plain(rows, width, percent)


def test_a_chain_and_a_large_group(spark):
    base = [f"t{i}" for i in range(200)]
    chain = [" ".join(base[i:i + 100]) for i in range(0, 60, 4)]
    group = [" ".join(base[:50] + [f"x{i}"] + base[50:120]) for i in range(300)]
    rows = list(enumerate(chain + group + ["alone " * 9]))
    assert joined(spark, rows, 4, 85) == plain(rows, 4, 85)


def test_nulls_empty_texts_and_repeats(spark):
    rows = [(None, "a b c d e"), (4, "a b c d e"), (3, "A  B\tC d e"), (None, "lone words"), (7, None), (8, ""), (9, " \n"), (9, " \n"), (5, "É x"),
            (6, "é x"), (2, "one"), (1, "ONE"), (10, "z " * 30_000), (11, "z z z z z")]
    assert joined(spark, rows, 4, 85) == plain(rows, 4, 85)
    assert joined(spark, [], 4, 85) == [] and joined(spark, [(1, None)], 4, 85) == [(1, 0, 1)]


def test_no_linked_pair_without_a_common_signature():
    """The prefix argument itself, on sets of all sizes with any tokens frequent."""
    pick = np.random.default_rng(0)
    for percent in (60, 80, 85, 95):
        bound = simjoin.Bound(percent)
        for _ in range(400):
            n = int(pick.integers(2, 120))
            pool = np.sort(pick.choice(1 << 50, n * 2, replace=False)).astype(np.uint64) | np.uint64(pick.integers(0, 3)) << np.uint64(56)
            often = pick.random(n * 2) < pick.choice([0, 0.3, 0.9, 1])
            x = np.sort(pick.choice(n * 2, n, replace=False))
            kept = x[pick.random(n) < pick.choice([0.8, 0.95, 1])]
            y = np.union1d(kept, pick.choice(n * 2, int(pick.integers(0, 1 + n // 10))))
            shared = len(np.intersect1d(x, y))
            if not len(y) or 100 * shared < percent * (len(x) + len(y) - shared) or len(x) == len(y) == shared:
                continue
            a, b = (simjoin.signatures(pool[i], often[i], bound) for i in (x, y))
            assert len(np.intersect1d(a[0], b[0])) or len(np.intersect1d(a[1], b[1]))
            assert bound.may_link(min(len(x), len(y)))


def test_bounds_that_prefixes_cannot_keep():
    for percent in (0, 59, 101):
        with pytest.raises(ValueError):
            simjoin.Bound(percent)


def test_bit_maps_bound_the_difference():
    pick = np.random.default_rng(1)
    for _ in range(50):
        x, y = (pick.integers(0, 1 << 62, 300).astype(np.uint64) for _ in range(2))
        y[:200] = x[:200]
        apart = sum(int(a ^ b).bit_count() if a ^ b >= 0 else (int(a ^ b) % 2**64).bit_count() for a, b in zip(simjoin.bit_map(x).tolist(), simjoin.bit_map(y).tolist()))
        assert apart <= 200


def test_components(spark):
    pick = random.Random(3)
    links = [(i, i + 1) for i in range(0, 300)] + [(pick.randrange(1000, 1400), pick.randrange(1000, 1400)) for _ in range(300)] + [(5, 5), (None, 3), (2000, 2001), (2000, 2001)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    root = {}

    def top(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    assert got == {i: top(i) for i in list(root)}
    assert components(df.limit(0)).count() == 0


@pytest.mark.parametrize("packed", [7, 100_000])
def test_components_are_the_same_however_many_links_are_joined_at_once(spark, monkeypatch, packed):
    monkeypatch.setattr("tradeloom.llm.components.PACKED", packed)
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)] + [("é", "n100"), ("n100", "𝄞"), ("x", "x"), (None, "y")]
    got = components(spark.createDataFrame(links, "a string, b string").repartition(3)).collect()
    assert sorted(tuple(r) for r in got) == sorted([(f"n{i:03}", "n000") for i in range(41)] + [(n, "n100") for n in ("n100", "é", "𝄞")])


def test_few_links_take_few_jobs(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long").repartition(4)
    spark.sparkContext.setJobGroup("few links", "")
    try:
        assert components(df).count() == 51
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few links")) <= 10
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_query(spark, sf):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in op9_simjoin(spark, sf).collect()) == plain(docs, 4, 85)


def test_packed_tokens():
    pick = np.random.default_rng(2)
    x = np.unique(pick.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2))
    assert (simjoin.unpacked(simjoin.packed(x)) >> np.uint64(16) == x >> np.uint64(16)).all()
    assert len(simjoin.unpacked(b"")) == 0


def test_pairs_of_many_common_signatures_meet_seldom(spark):
    pick = random.Random(5)
    sigs = [pick.randrange(-2**63, 2**63) for _ in range(400)]
    held = {c: pick.sample(sigs, 200) for c in range(40)}
    held |= {100: [7], 101: [7, sigs[0]], 102: [-9], 103: None}  # few signatures, and such of none else
    rest = [(s, c, c % 30) for c, some in held.items() for s in some or []]
    bits = simjoin.bit_map(np.arange(50, dtype=np.uint64)).tolist()
    sizes = {c: 50 if c % 2 else 30 for c in held}
    rest = spark.createDataFrame(rest, "sig long, class long, root long")
    classes = spark.createDataFrame([(c, c, n, bits) for c, n in sizes.items()], "class long, key long, n long, bits array<long>")
    met = [tuple(r) for r in simjoin.meetings(rest, classes, simjoin.Bound(80)).select("a", "b").collect()]
    wanted = {(a, b) for a in held for b in held if a < b and a % 30 != b % 30 and sizes[a] == sizes[b]
              and set(held[a] or []) & set(held[b] or [])}
    assert set(met) == wanted
    assert len(met) < 10 * len(wanted)  # of about 70 common signatures each
