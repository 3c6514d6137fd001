import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from oracle_compare import connect
from tradeloom.llm import tokenalign
from tradeloom.llm.queries import op13_tokenalign

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(BPE)
    a.encode_special_tokens = True
    names = a.get_vocab()
    letters = tokenalign.byte_letters()
    bytes_a = {i: bytes(letters[c] for c in name) for name, i in names.items() if all(c in letters for c in name)}
    b = SentencePieceProcessor(model_file=PIECES)

    def bytes_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return a, bytes_a, b, bytes_b


def plain(docs, encoders):
    """Rows by the byte ranges of all tokens of a document against each other."""
    a, bytes_a, b, bytes_b = encoders
    held, counts = [], Counter()
    for key, text in docs:
        x = a.encode(" " + (text or ""), add_special_tokens=False).ids
        y = b.encode(text or "")
        tokens_a, tokens_b = [bytes_a[i] for i in x], [bytes_b(i) for i in y]
        if not text or b"".join(tokens_a) != b" " + text.encode() or b"".join(tokens_b) != b" " + text.encode():
            held.append((key, None))
            continue

        def ranges(tokens):
            ends = np.cumsum([len(t) for t in tokens]).tolist()
            return list(zip([0, *ends[:-1]], ends))

        ra, rb = ranges(tokens_a), ranges(tokens_b)
        linked, first = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[first][1] <= s:
                first += 1
            j = first
            while j < len(rb) and rb[j][0] < e:
                linked.append((i, j))
                j += 1
        common = sorted({e for _, e in ra} & {e for _, e in rb})
        place = {end: n for n, end in enumerate(common)}
        parts = [([], []) for _ in common]
        for side, ids, ranges_of in ((0, x, ra), (1, y, rb)):
            group = 0
            for token, (_, e) in zip(ids, ranges_of):
                parts[group][side].append(str(token))
                group += e in place
        parts = [",".join(p) + "|" + ",".join(q) for p, q in parts]
        pairs = [(x[i], y[j]) for i, j in linked]
        counts.update(pairs)
        held.append((key, (len(x), len(y), len(common), pairs, hashlib.sha256(";".join(parts).encode()).hexdigest())))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for key, found in held:
        if found is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, pairs, digest = found
            out.append((key, n_a, n_b, n_groups, len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), digest))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def aligned(spark, docs, parts=3):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    return tokenalign.align_corpus(df, "doc_id", "text", BPE, PIECES)


ODD = ["", None, " ", "a", " leading", "trailing ", "two  spaces   three", "line\n\nbreaks\tand\ttabs", "▁piece space", "ﬁ Ⅳ ½ é",
       "<s>not special</s> <|endoftext|> <unk> <0x41>", "\x00\x01", "日本語のテキスト", "🙂🙃 emoji", "a b", "it's 'quoted' don't", "x" * 3000,
       "12345678901234567890", "word " * 2000, "a​b", "Ünïcödé wörds", "repeat", "repeat"]


@pytest.mark.parametrize("by_join", [False, True])
def test_against_all_ranges(spark, encoders, monkeypatch, by_join):
    if by_join:
        monkeypatch.setattr(tokenalign, "BROADCAST_PAIRS", 0)
    monkeypatch.setattr(tokenalign, "HELD_PAIRS", 50)
    rng = random.Random(3)
    letters = "abc deé\n日🙂'.1 "
    docs = list(enumerate(ODD)) + [(100 + i, "".join(rng.choice(letters) for _ in range(rng.randrange(80)))) for i in range(60)] + [(None, "no id"), (7, "again")]
    assert got(aligned(spark, docs)) == plain(docs, encoders)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.data())
def test_groups_and_links(sizes, data):
    ends_a = np.cumsum(sizes)
    inner = data.draw(st.sets(st.integers(1, int(ends_a[-1]) - 1)) if ends_a[-1] > 1 else st.just(set()))
    drop = data.draw(st.booleans())
    ends_b = np.array(sorted((set(ends_a.tolist()) - inner if drop else inner) | {int(ends_a[-1])}))
    cut_a, cut_b = tokenalign.groups(ends_a.tolist(), ends_b.tolist())
    common = np.intersect1d(ends_a, ends_b)
    assert ends_a[cut_a - 1].tolist() == ends_b[cut_b - 1].tolist() == common.tolist()
    at_a, at_b = tokenalign.links(ends_a, ends_b)
    starts_a, starts_b = np.append(0, ends_a[:-1]), np.append(0, ends_b[:-1])
    wanted = [(i, j) for i in range(len(ends_a)) for j in range(len(ends_b)) if starts_a[i] < ends_b[j] and starts_b[j] < ends_a[i]]
    assert list(zip(at_a.tolist(), at_b.tolist())) == sorted(wanted)
    assert len(wanted) == len(ends_a) + len(ends_b) - len(common)


def test_stretches_are_jumped():
    """Comparisons grow with the logarithm of a stretch, not with its length."""
    class Counted(list):
        looks = 0

        def __getitem__(self, i):
            Counted.looks += 1
            return list.__getitem__(self, i)

    a = Counted(range(1, 100_001))
    tokenalign.groups(a, list(range(1, 50_000)) + list(range(50_001, 100_001)))
    assert Counted.looks < 200


def test_empty_frame_and_names(spark):
    df = spark.createDataFrame([], "n_a long, text string, links string")
    out = tokenalign.align_corpus(df, "n_a", "text", BPE, PIECES)
    assert out.columns == ["n_a", "n_a_", *COLUMNS[1:]] and out.collect() == []


def test_query_against_all_ranges(spark, sf, encoders):
    docs = connect(sf).sql("SELECT doc_id, text FROM documents").fetchall()
    assert got(op13_tokenalign(spark, sf)) == plain(docs, encoders)
