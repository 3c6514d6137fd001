import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from test_simjoin import plain as plain_groups
from tradeloom.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """What went into each stage and what came out, written and read again between them."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        result = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, result)
        docs = result
    return out


def test_columns(stages, spark, sf):
    wanted = spark.read.parquet(f"{sf}/documents.parquet").schema.simpleString()
    for name in list(stages)[:-1]:
        assert stages[name][1].schema.simpleString() == wanted


def test_quality_keeps_good_documents_and_drops_bad_ones(stages, spark, sf):
    kept = {r["doc_id"] for r in stages["quality"][1].collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    good = [r["doc_id"] in kept for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] in kept for r in labels if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_one_of_each_group_stays(stages):
    given, left = stages["near_copies"]
    rows = [(r["doc_id"], r["text"]) for r in given.collect()]
    want = sorted({c for _, _, c in plain_groups(rows, 5, 80)})
    assert sorted(r["doc_id"] for r in left.collect()) == want


def test_personal_data_is_masked(stages):
    from test_pii import plain
    given, masked = stages["pii"]
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    for r in masked.collect():
        assert r["n_chars"] == len(r["text"]) and not [s for s in plain(r["text"]) if s[0] in ("email", "ip")]
        if not plain(texts[r["doc_id"]]):
            assert r["text"] == texts[r["doc_id"]]


def test_mixing_loses_no_document(stages):
    given, mixed = stages["mixing"]
    used = Counter(r["doc_id"] for r in mixed.collect())
    assert set(used) == {r["doc_id"] for r in given.collect()} and set(used.values()) <= {1, 2}


def test_packing_holds_every_token_once(stages):
    given, packed = stages["packing"]
    t = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = sum(len(t.encode(r["text"], add_special_tokens=False).ids) + 1 for r in given.collect())
    rows = packed.collect()
    assert sum(r["length"] for r in rows) == want and len({r["sequence_id"] for r in rows}) == len(rows)


def test_run_is_all_stages(spark, sf, stages):
    def digest(df):
        return Counter((r["doc_id"], r["start"], r["length"], zlib.crc32(bytes(r["ids"]))) for r in df.collect())

    assert digest(corpus_pipeline.run(spark, sf)) == digest(stages["packing"][1])


def test_odd_documents(spark, sf):
    rows = [(None, None, None, None, None), (None, "x y z", "en", "a", 5), (1, "", None, None, 0), (1, "", None, None, 0), (2, "word " * 50_000, "en", "a", 1),
            (3, "A short and friendly text about the weather in the north.", "en", None, 57)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, SCHEMA)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf)
            out.collect()
            if name != "packing":
                assert out.columns == corpus_pipeline.COLUMNS


def test_near_copies_of_rows_that_share_an_id_or_have_none(spark, sf):
    one, other, third = (" ".join(f"{w}{i}" for i in range(60)) for w in "xyz")
    rows = [(1, one), (5, one + " more"), (5, other), (None, third), (None, third + " more"), (None, "alone " + other[:20]), (7, "again"), (7, "again")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA)
    got = Counter((r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)["near_copies"](spark, docs, sf).collect())
    assert got.pop((None, third), 0) + got.pop((None, third + " more"), 0) == 1
    assert got == Counter([(1, one), (5, other), (None, "alone " + other[:20]), (7, "again")])


def test_every_operator_is_registered():
    assert [n for n in QUERIES] == sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) and len(QUERIES) == 10
    assert set(ORACLE) <= set(QUERIES) and 4 <= len(corpus_pipeline.STAGES) <= 5
