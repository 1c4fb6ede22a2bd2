import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import CLASHING, DOCS, clashing, messy_docs
from tonestream.llm import suffix_dedup


def plain(texts, window):
    """(bytes, removed, runs, hash of what stays) by counting every window."""
    seen, out = Counter(), []
    for t in texts:
        seen.update(t[i:i + window] for i in range(len(t) - window + 1))
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(t, gone) if not g)).hexdigest()))
    return out


def made(letters, seed, n=50):
    r = random.Random(seed)
    base = ["".join(r.choice(letters) for _ in range(r.randint(5, 130))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = (r.choice(base)[r.randint(0, 10):] if r.random() < 0.6 else "".join(r.choice(letters) for _ in range(20)) for _ in range(r.randint(0, 4)))
        texts.append("".join(parts) + "z" * r.choice([0, 0, 0, 70]))
    return texts + [texts[3], "", texts[5] * 2]


@pytest.mark.parametrize("bucket", [6_000_000, 25])  # buckets in tasks, and through a shuffle
@pytest.mark.parametrize("letters", ["ab", "abcé "])
def test_against_all_windows(spark, letters, bucket):
    texts = made(letters, len(letters))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in suffix_dedup.removed(df, window=32, gram=8, bucket=bucket, keep_bytes=True).collect()}
    want = plain([t.encode() for t in texts], 32)
    assert [(got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) for i in range(len(texts))] == want
    for i, t in enumerate(texts):
        raw = bytearray(t.encode())
        for a, b in reversed(list(zip(got[i].spans[::2], got[i].spans[1::2]))):
            del raw[a:b + 1]
        assert bytes(raw) == bytes(got[i].kept)


def test_slices_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 100)
    monkeypatch.setattr(suffix_dedup, "STEP", 500)
    texts = ["".join(made("abc", 9)), *made("abc", 9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removed(df, window=32, gram=8).collect()}
    assert [got[i] for i in range(len(texts))] == plain([t.encode() for t in texts], 32)


def test_every_window_has_one_anchor():
    text = np.frombuffer(b"abcabcabd" * 400, np.uint8)
    h, c, first, last, place = suffix_dedup.anchors(text, 40, 8)
    assert first[0] == 0 and last[-1] == len(text) - 40 and (first[1:] == last[:-1] + 1).all()
    assert ((place >= last) & (place <= first + 32)).all()


@pytest.mark.parametrize("schema, rows", [(DOCS, messy_docs(n=60)), (CLASHING, clashing(messy_docs(n=60)))])
def test_messy_rows(spark, schema, rows):
    rows = [r for r in rows if r[0] != 503]
    got = suffix_dedup.removed(spark.createDataFrame(rows, schema), window=100, gram=16).collect()
    want = [(r[0], *x) for r, x in zip(rows, plain([(r[1] or "").encode() for r in rows], 100), strict=True)]
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=str) == sorted(want, key=str)


def test_empty(spark):
    assert suffix_dedup.removed(spark.createDataFrame([], DOCS)).count() == 0


def test_refinement_against_the_windows_themselves():
    r = random.Random(4)
    for window in (1, 3, 8, 9, 20, 37, 64):
        contexts = [bytes(r.choice(b"ab") for _ in range(window + r.randint(0, 60))) for _ in range(12)]
        contexts += [contexts[0], b"a" * (window + 50), contexts[1][:window], contexts[2] + contexts[3]]
        spans = np.array([len(c) - window for c in contexts])
        seen = Counter(c[i:i + window] for c in contexts for i in range(len(c) - window + 1))
        want = [seen[c[i:i + window]] > 1 for c in contexts for i in range(len(c) - window + 1)]
        for gram in (1, 5, 64):
            assert suffix_dedup.repeated_windows(contexts, spans, window, gram).tolist() == want


def test_one_bucket_with_a_third_of_all_rows(spark):
    r = random.Random(8)
    shared = "".join(r.choice("abcdefgh") for _ in range(60))
    texts = ["".join(r.choice("abcdefgh") for _ in range(r.randint(0, 90))) for _ in range(120)]
    texts += ["".join(r.choice("xyz") for _ in range(r.randint(5, 40))) + shared + "".join(r.choice("xyz") for _ in range(20)) for _ in range(60)]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in suffix_dedup.removed(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), window=40, gram=8).collect()}
    assert [got[i] for i in range(len(texts))] == plain([t.encode() for t in texts], 40)
