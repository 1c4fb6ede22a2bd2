import json
import random

import pytest

from tonestream.llm import merge_transducer
from tonestream.llm.common import byte_letters

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
LETTERS = byte_letters()


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH).model


@pytest.fixture(scope="module")
def merges():
    return merge_transducer.load(PATH)


def words(seed, n):
    r = random.Random(seed)
    letters = ["etaoinaa", "abcdefghijklmnopqrstuvwxyzABCDE", "aab", "é日😀 ", " the", "01-=_"]
    return ["".join(r.choice(some) for _ in range(r.randint(1, 30))) for some in r.choices(letters, k=n)]


def plain(library, word):
    spelled = "".join(LETTERS[b] for b in word.encode())
    return len(library.tokenize(spelled))


def test_counts_equal_the_library_s_merges(merges, library):
    for word in [*words(1, 6000), "x" * 3000, "-" * 1001, "日本" * 400, " " * 700]:
        assert merges.tokens(word.encode()) == plain(library, word), word


def test_a_few_states_are_enough(merges, library, monkeypatch):
    monkeypatch.setattr(merge_transducer, "STATE_LIMIT", 50)
    few = merge_transducer.load(PATH)
    for word in words(2, 1500):
        assert few.tokens(word.encode()) == plain(library, word), word
        assert len(few.states) <= 52


def tiny(pairs):
    """A model of all bytes and these merges."""
    vocab = {letter: i for i, letter in enumerate(LETTERS.values())}
    for a, b in pairs:
        vocab.setdefault(a + b, len(vocab))
    return {"type": "BPE", "dropout": None, "unk_token": None, "vocab": vocab, "merges": [f"{a} {b}" for a, b in pairs]}


@pytest.mark.parametrize("seed", range(12))
def test_random_merges_against_the_library(seed):
    r = random.Random(seed)
    parts, pairs = ["a", "b", "c"], []
    while len(pairs) < 14:
        a, b = r.choice(parts), r.choice(parts)
        if a + b not in parts and len(a + b) < 9:
            parts.append(a + b)
            pairs.append((a, b))
    model = tiny(pairs)
    library = tokenizers.models.BPE(model["vocab"], pairs)
    mine = merge_transducer.MergeTransducer(model)
    for _ in range(1500):
        word = "".join(r.choice("abc") for _ in range(r.randint(0, 24)))
        assert mine.tokens(word.encode()) == len(library.tokenize(word)), (pairs, word)


def test_other_models_are_refused():
    fine = tiny([("a", "b"), ("ab", "c")])
    assert merge_transducer.MergeTransducer(fine).tokens(b"abcab") == 2
    for bad in (fine | {"type": "WordPiece"}, fine | {"dropout": 0.1}, fine | {"ignore_merges": True}, fine | {"merges": ["ab c", "a b"]}):
        with pytest.raises(ValueError):
            merge_transducer.MergeTransducer(json.loads(json.dumps(bad)))
    twice = tiny([("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")])
    with pytest.raises(ValueError):
        merge_transducer.MergeTransducer(twice)
