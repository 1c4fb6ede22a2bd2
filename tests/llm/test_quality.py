import random
import zlib

from tests.llm.helpers import CLASHING, DOCS, clashing, messy_docs
from tonestream.llm import quality

LABELS = "doc_id long, quality int"


def prose(r, good):
    words = [f"{a}{b}" for a in ("ther", "on", "ing", "est") for b in ("a", "en", "or", "is", "ly")]
    if good:
        return " ".join(r.choice(words) for _ in range(r.randint(20, 80))) + "."
    return " | ".join(r.choice(words).upper() + "$$$" for _ in range(r.randint(20, 80)))


def corpus(n=600):
    r = random.Random(2)
    rows = [(i, prose(r, i % 4), "en", "a", 1) for i in range(n)]
    return rows, [(i, int(i % 4 > 0)) for i in range(n)]


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    model = quality.learn(docs, spark.createDataFrame(labels, LABELS))
    got = quality.score(docs, model).collect()
    truth = dict(labels)
    held = [g for g in got if g.held_out]
    assert {g.doc_id for g in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(g.predicted == truth[g.doc_id] for g in held) >= 0.95 * len(held)
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.3) for g in got)


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, DOCS)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    models = [quality.learn(docs, spark.createDataFrame(x, LABELS)) for x in (labels, flipped)]
    assert models[0] == models[1]


def test_scores_on_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality.score(docs, quality.learn(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert sum(g.predicted == g.quality for g in got) >= 0.95 * len(got)


def test_messy_rows(spark):
    rows, labels = corpus(200)
    labels += [(500, 1), (501, None), (None, 1), (7, None)]
    rows = clashing(rows + [(i + 10_000 if i is not None and i < 400 else i, *r) for i, *r in messy_docs()])
    docs = spark.createDataFrame(rows, CLASHING)
    model = quality.learn(docs, spark.createDataFrame(labels, LABELS))
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(g.held_out for g in got if g.doc_id is None)
    both = model.compressors()
    a, b, c = model.weights
    import math

    for g in got:
        if g.doc_id == 501:
            assert abs(g.score - 1 / (1 + math.exp(-max(-30, min(30, c))))) < 1e-12
    assert quality.features(b"", both) == (0.0, 0.0)
    kept = quality.keep(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(g.predicted for g in got)


def test_without_labels_or_documents(spark):
    empty, none = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert quality.score(empty, quality.learn(empty, none)).count() == 0
    some = spark.createDataFrame(corpus(20)[0], DOCS)
    assert {r.score for r in quality.score(some, quality.learn(some, none)).collect()} == {0.5}
    assert quality.learn(some, spark.createDataFrame([(1, 1), (2, 1)], LABELS)).bad == b""


def test_scores_recomputed_in_plain_python(spark):
    import math

    import zstandard

    rows, labels = corpus(300)
    rows += [(i + 10_000 if i is not None else None, *r) for i, *r in messy_docs()]
    docs = spark.createDataFrame(rows, DOCS)
    model = quality.learn(docs, spark.createDataFrame(labels, LABELS))
    trained = [zstandard.ZstdCompressionDict(raw) for raw in (model.bad, model.good)]

    def size(text, dictionary):
        whole = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(whole.compress(text[a:a + 256])) for a in range(0, len(text), 256))

    want = []
    for i, text, *_ in rows:
        raw = (text or "").encode()
        bad, good = ((size(raw, d) / len(raw) if raw else 0.0) for d in trained)
        z = model.weights[0] * (bad - good) + model.weights[1] * good + model.weights[2]
        want.append((str(i), 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))))
    got = [(str(g.doc_id), g.score) for g in quality.score(docs, model).collect()]
    assert len(got) == len(want)
    for (i, x), (j, y) in zip(sorted(got), sorted(want), strict=True):
        assert i == j and abs(x - y) < 1e-9


def test_one_text_of_many_megabytes(spark):
    rows, labels = corpus(200)
    model = quality.learn(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    r = random.Random(8)
    good, bad = (" ".join(prose(r, kind) for _ in range(25_000)) for kind in (True, False))
    assert min(len(good), len(bad)) > 5_000_000
    got = quality.score(spark.createDataFrame([(1, good, "en", "a", 1), (2, bad, "en", "a", 1)], DOCS), model).collect()
    assert {g.doc_id: g.predicted for g in got} == {1: 1, 2: 0}
