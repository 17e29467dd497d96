"""Periodic runs, byte-level BPE and spelling variants against plain versions."""

import base64
import hashlib
import random
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.llm import bpe, periodic, spelling
from voltframe.llm.common import table

SF = "/root/testdata/sf0.001"


def texts_of(spark):
    return {r.doc_id: r.text or "" for r in table(spark, SF, "documents").select("doc_id", "text").collect()}


# ---------------------------------------------------------------- periodic runs

def plain_runs(w):
    """Every stretch of equal words q apart, kept if no shorter period fits."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            part = w[s:s + length]
            if i > s and length >= max(6, 4 * q) and not any(part[r:] == part[:-r] for r in range(1, q)):
                out.append((s, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_plain_search():
    r = random.Random(2)
    for _ in range(600):
        docs = []
        for _ in range(r.randint(1, 4)):
            k = r.choice([1, 2, 2, 3, 10])
            w = [b"%d" % r.randrange(k) for _ in range(r.randint(0, 40))]
            for _ in range(r.randint(0, 3)):
                unit = [b"%d" % r.randrange(k) for _ in range(r.randint(1, 25))]
                w += (unit * r.randint(2, 9))[:r.randint(1, 120)] + [b"x"] * r.randint(0, 2)
            docs.append(w)
        for w, found in zip(docs, periodic.runs_of(docs)):
            assert [tuple(x) for x in found.tolist()] == plain_runs(w)


def test_wavelet_successor_equals_plain():
    r = np.random.default_rng(1)
    for n in (1, 2, 3, 17, 64, 200):
        values = r.permutation(n)
        tree = periodic.WaveletTree(values)
        left = r.integers(0, n, 300)
        right = left + r.integers(0, n - left + 1)
        bound = r.integers(0, n + 2, 300)
        want = [min([v for v in values[a:b] if v >= x], default=-1) for a, b, x in zip(left, right, bound)]
        assert tree.successor(left, right, bound).tolist() == want


def test_long_texts_of_few_words():
    assert periodic.runs_of([[b"a"] * 300_000])[0].tolist() == [[0, 300_000, 1]]
    unit = [b"%d" % i for i in range(1000)]
    assert periodic.runs_of([[b"x"] + unit * 200])[0].tolist() == [[1, 200_000, 1000]]


def planted(doc, text):
    w = text.encode().split()
    n, h = len(w), zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_op11_equals_plain_version(spark):
    texts = texts_of(spark)
    got = {r.doc_id: r for r in periodic.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(texts)
    assert any(r.n_runs for r in got.values())
    for doc, text in texts.items():
        w, r = planted(doc, text), got[doc]
        runs = plain_runs(w) if len(w) < 1500 else [tuple(x) for x in periodic.find_runs(
            np.unique(np.array(w), return_inverse=True)[1]).tolist()]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()


def test_periodic_odd_rows(spark, docs, empty):
    got = periodic.periodic_runs(docs).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    assert [tuple(x) for x in by_id[1].runs] == [(0, 120, 4)] and by_id[1].collapsed == "alpha beta gamma delta"
    assert by_id[3].n_words == 0 and by_id[3].runs == [] and by_id[3].collapsed == ""
    assert by_id[5].n_words == 30_000
    assert periodic.periodic_runs(empty).count() == 0


# --------------------------------------------------------------------- byte BPE

@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers
    import tiktoken
    with open(bpe.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(bpe.vocabulary_path())


def ids(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def test_ids_equal_the_library(encoder, own):
    r = random.Random(1)
    for _ in range(3000):
        letters = r.choice(["ab", "aeinst", "aeinst rhdl", "aeé ñüß中𝒳!?0 1\n\t's"])
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 200)))
        assert ids(own, text) == encoder.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()
    # letters that only the newest Unicode version has may be split otherwise
    assigned = [c for c in range(0x20000) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    for first in range(0, len(assigned), 7):
        text = "".join(f"a{chr(c)}b {chr(c)}" for c in assigned[first:first + 7])
        assert ids(own, text) == encoder.encode_ordinary(text)


def test_pieces_made_of_tokens_equal_the_merges(own):
    """Bytes that need not be text, where the longest token is often wrong."""
    r, tokens = random.Random(4), list(own.rank)
    for _ in range(3000):
        piece = b"".join(r.choice(tokens) for _ in range(r.randint(1, 6)))
        want = [own.rank[piece]] if piece in own.rank else own.merged(piece)
        assert own.piece_ids(piece) == want


def test_long_piece_is_linear(encoder, own):
    for text in ("ab" * 200_000, "a" * 400_000, "x" + "ing" * 100_000):
        assert ids(own, text) == encoder.encode_ordinary(text)


def test_split_in_parts_equals_split_at_once(own, monkeypatch):
    text = "some words, 12 numbers\n\n  and   blanks " * 50
    want = own.encode(text)
    monkeypatch.setattr(bpe, "SPLIT_CHARS", 10)
    assert own.encode(text) == want


def test_op12_equals_the_library(spark, encoder):
    texts = texts_of(spark)
    got = bpe.op12_byte_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = np.array(encoder.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_odd_rows(spark, docs, empty):
    got = bpe.bpe_round_trip(docs).collect()
    want = Counter((r.doc_id, (r.text or "").encode()) for r in docs.collect())
    assert Counter((r.doc_id, bytes(r.decoded)) for r in got) == want
    assert all(len(r.ids) % 4 == 0 for r in got)
    assert bpe.bpe_round_trip(empty).count() == 0


# ------------------------------------------------------------ spelling variants

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    """word -> form, root, n, n_near, form_n by comparing all words."""
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    out = {}
    for w, n in counts.items():
        others = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if near(v, w)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 10 * n else None
        out[w] = [form, w, n, len(others), counts[form] if form else None]
    for w in out:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return out


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in spelling.RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def as_dict(rows):
    return {r.word: [r.form, r.root, r.n, r.n_near, r.form_n] for r in rows}


def test_op13_equals_comparing_all_words(spark):
    want = plain_variants(plain_words(texts_of(spark).items()))
    rows = spelling.op13_spelling_variants(spark, SF).collect()
    assert len(rows) == len(want) and as_dict(rows) == want


@pytest.mark.parametrize("cell_words", [40, 300, 10_000])
def test_variants_over_many_cells(spark, cell_words):
    r = random.Random(6)
    words = {"".join(r.choice("abcéñ") for _ in range(r.randint(7, 9))): r.randint(2, 9) for _ in range(300)}
    for w in list(words)[:150]:
        words[w] *= r.choice([1, 10, 100, 1000])
        for _ in range(4):
            i = r.randrange(len(w))
            v = r.choice([w[:i] + r.choice("abÿ") + w[i:], w[:i] + w[i + 1:], w[:i] + r.choice("abé") + w[i + 1:]])
            if len(v) >= 7:
                words.setdefault(v, r.randint(2, 30))
    words |= {"a" * 140: 5, "a" * 141: 60, "a" * 139 + "b": 700, "stressed": 2, "desserts": 2}
    df = spark.createDataFrame([(w, n, "clash") for w, n in words.items()], "word string, n long, root string")
    assert as_dict(spelling.spelling_variants(df, cell_words).collect()) == plain_variants(words)


def test_spelling_odd_rows(spark, docs, empty):
    got = {r.word: r.n for r in spelling.planted_words(docs).collect()}
    want = plain_words((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None)
    assert got == want
    assert spelling.spelling_variants(spelling.planted_words(empty)).count() == 0
    nulls = docs.withColumn("text", F.lit(None).cast("string"))
    assert spelling.spelling_variants(spelling.planted_words(nulls)).count() == 0
