import random

import pytest

from tests.llm.helpers import CLASHING, DOCS, clashing, messy_docs
from tonestream.llm import token_count

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_counts_equal_the_library_s(library):
    r = random.Random(4)
    counter = token_count.Counter(PATH, token_count.char_classes(PATH))
    parts = ["a", "b", "s", "t", "re", "ve", "ll", "l", "r", "v", "e", "'", "'", " ", " ", "\n", "\t", "1", "²", "!", ".", "é", "日",
             " ", "\u0085", "\x1c", "　", "😀", "<|endoftext|>", "́", "I", "'re"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(4000)] + ["", " ", "\n\n", "x" * 3000, " " * 3000]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.counts(texts).tolist() == want


def test_classes_are_the_splitter_s(library):
    kinds, r = token_count.char_classes(PATH), random.Random(6)
    probes = {"a": (0, 1, 2, 3, 4), "1": (5,), "!": (8, 9)}
    for point in [*range(0x3000), *(r.randrange(0x3000, 0x110000) for _ in range(20_000))]:
        if not 0xD800 <= point < 0xE000:
            stays = [c for c in probes if len(library.pre_tokenizer.pre_tokenize_str(c + chr(point))) == 1]
            assert [c for c in probes if kinds[point] in probes[c]] == stays, hex(point)


def test_the_library_isn_t_called(monkeypatch):
    counter = token_count.Counter(PATH, token_count.char_classes(PATH))
    monkeypatch.setattr(tokenizers.Tokenizer, "from_file", None)
    assert counter.counts(["to be or not", "x" * 50]).tolist()[0] == 4


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 64])
def test_chunk_maps_compose(chunk):
    import numpy as np

    r = np.random.default_rng(chunk)
    tables = token_count.compile_splitter()
    for n in (1, 2, 5, 63, 64, 65, 1000):
        classes = r.integers(0, 11, n).astype(np.uint8)
        classes[-1] = token_count.END
        assert token_count.begins(classes, *tables, chunk=chunk).tolist() == token_count.begins(classes, *tables, chunk=4096).tolist()


@pytest.mark.parametrize("schema, rows", [(DOCS, messy_docs()), (CLASHING, clashing(messy_docs()))])
def test_count_tokens(spark, library, schema, rows):
    got = token_count.count_tokens(spark.createDataFrame(rows, schema), PATH).collect()
    want = []
    for r in rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want.append((r[0], len((r[1] or "").encode()), n, n > 512))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_count.char_classes(public.path("word_bpe_49k.json"))


def test_empty(spark):
    assert token_count.count_tokens(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_one_text_of_many_megabytes(spark, library):
    r = random.Random(9)
    words = [f"{a}{b}" for a in ("ther", "on", "ING", "est", "é", "日") for b in ("a", "en", "'ll", " ", ", ", "12")]
    text = " ".join(r.choice(words) for _ in range(1_200_000))
    (got,) = token_count.count_tokens(spark.createDataFrame([(1, text, "en", "a", 1)], DOCS), PATH).collect()
    assert got.n_bytes == len(text.encode()) > 5_000_000
    assert got.n_tokens == len(library.encode(text, add_special_tokens=False).ids) and got.over_limit
