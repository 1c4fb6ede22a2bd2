import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.helpers import CLASHING, DOCS, clashing, messy_docs
from tonestream.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def pack32(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_ids_are_the_library_s(library):
    r = random.Random(1)
    letters = ["a", "B", "st", "'s", "'", " ", "\n", "1", "²", "!", "...", "é", "Ü", "日", "\u0085", "\x1c", "\x0b", " ", "😀",
               "<|endoftext|>", "́", "İ", "Σ", "​", "\x00", "각", "ŉ", "ſ", "ﬁ", "|", "-"]
    words = packing.WordIds(PATH)
    for _ in range(4000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 25)))
        assert words.ids(text) == pack32(library.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("capacity", [5, 8, 13, 20])
def test_plans_are_valid_and_dominance_never_costs_a_sequence(capacity):
    r = random.Random(capacity)
    for _ in range(300):
        counts = Counter(r.randint(1, capacity) for _ in range(r.randint(0, 9)))
        plan, seen, filled = packing.plan(counts, capacity), Counter(), defaultdict(list)
        for w, _, items, each, sequence, offset in plan.runs:
            for i in range(items):
                filled[sequence + i // each].append((offset + i % each * w, w))
                seen[w] += 1
        assert seen == +counts and len(filled) == plan.sequences
        for places in filled.values():
            at = 0
            for offset, w in sorted(places):
                assert offset == at
                at += w
            assert at <= capacity
        reduced = packing.Plan(counts, capacity)
        reduced.reduce()
        assert fewest(counts, capacity) == reduced.sequences + fewest(reduced.left, capacity)


def fewest(counts, capacity):
    """The fewest sequences, by trying everything."""
    items = sorted((w for w, n in counts.items() for _ in range(n)), reverse=True)
    best = [len(items)]

    def put(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in sorted(set(rooms)):
            if room >= items[i]:
                rest = list(rooms)
                rest.remove(room)
                put(i + 1, [*rest, room - items[i]])
        put(i + 1, [*rooms, capacity - items[i]])

    if items:
        put(0, [])
    return best[0]


@pytest.mark.parametrize("schema, rows", [(DOCS, messy_docs()), (CLASHING, clashing(messy_docs()))])
def test_pack(spark, library, schema, rows):
    got = packing.pack(spark.createDataFrame(rows, schema).repartition(5), PATH, keep_ids=True).collect()
    want = Counter()
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start:start + 2048]
            want[r[0], piece, start, len(part), zlib.crc32(pack32(part)), pack32(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == want
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(filled) <= -(-total // 2048) + 1


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], DOCS), PATH).count() == 0


@pytest.mark.parametrize("change", [
    {"normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}]}},
    {"normalizer": None}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}])
def test_tokenizers_with_other_rules_are_refused(tmp_path, change):
    import json

    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec | change))
    with pytest.raises(ValueError):
        packing.WordIds(str(other))
    with pytest.raises(ValueError):
        packing.WordIds(public.path("byte_bpe_50k.json"))


def test_one_text_of_many_megabytes(spark, library):
    r = random.Random(9)
    words = [f"{a}{b}" for a in ("ther", "on", "ING", "est", "é") for b in ("a", "en", "or", " ", ", ")]
    text = " ".join(r.choice(words) for _ in range(1_500_000))
    assert len(text.encode()) > 5_000_000
    got = packing.pack(spark.createDataFrame([(1, text, "en", "a", 1), (2, "short", "en", "a", 1)], DOCS), PATH).where("doc_id = 1").collect()
    ids = [*library.encode(text, add_special_tokens=False).ids, 0]
    got = sorted(got, key=lambda g: g.piece)
    assert [g.start for g in got] == list(range(0, len(ids), packing.CAPACITY)) and sum(g.length for g in got) == len(ids)
    assert all(g.ids_crc32 == zlib.crc32(pack32(ids[g.start:g.start + g.length])) for g in got)
