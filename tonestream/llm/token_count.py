"""Exact token counts: a splitter and a tokenizer's merges, compiled into finite-state transducers.

Method: the splitter of a byte-level BPE tokenizer is compiled into a deterministic
transducer over character classes whose transitions emit "a pre-token begins here"
(at the character read or the one before it). Texts are laid end to end, cut into
chunks of equal length, and all chunks are stepped at once from *every* start state;
a chunk thus becomes a map start state -> (end state, what it emits). The maps compose by a
parallel prefix scan, which gives each chunk its true start state, so a very long
text needs no serial pass. The merges are compiled into a second transducer over bytes, whose transitions carry
the change of the number of tokens (``merge_transducer``). It starts anew where a pre-token begins, so the map of a
pre-token is the same from every state, and composing them is adding their counts. Counts of whole
pre-tokens are kept in a bounded table. The library's own BPE isn't called.

The character classes are read off the tokenizer's own splitter, so they agree with the library's Unicode
tables: blocks of code points that Python takes for one class are confirmed whole, others are halved. Where a tokenizer isn't of
this kind, ``compile_splitter`` says so instead of counting wrongly.

Counts equal the library's ``encode(text, add_special_tokens=False)``: special
strings inside a text count as one token each and split the text.

Defined results: null text counts as empty and has 0 tokens and 0 bytes; rows that
repeat are counted each; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonestream.llm.common import once_a_worker, small_batches
from tonestream.llm.merge_transducer import MergeTransducer

#: Most pre-tokens whose counts a worker keeps; beyond it the table starts anew.
TABLE_LIMIT = 1_000_000
#: Code points in a chunk, and in a group of texts that is stepped at once.
CHUNK, GROUP = 512, 1 << 20

# --- character classes -----------------------------------------------------------
# letters that matter to contractions have a class of their own
LETTER, L_STMD, L_RV, L_E, L_L, NUMBER, SPACE, WHITE, QUOTE, OTHER, END = range(11)
LETTERS = (LETTER, L_STMD, L_RV, L_E, L_L)
# --- splitter states ---------------------------------------------------------------
S_START, S_SPACE, S_LETTER, S_NUMBER, S_OTHER, S_QUOTE, S_RV, S_LL, S_DONE, S_WHITE, S_RUN_SPACE, S_RUN_WHITE = range(12)
#: Emissions: a pre-token begins at the character read, or at the one before it.
HERE, BEFORE = 1, 2


def compile_splitter() -> tuple[np.ndarray, np.ndarray]:
    """``(next, emit)`` tables, [state, class], of the byte-level splitter:
    contractions, then an optional space with letters, numbers or other
    characters, then white space, whose last character goes to what follows."""
    nxt, out = np.zeros((12, 11), np.int8), np.zeros((12, 11), np.int8)
    begin = {**{c: S_LETTER for c in LETTERS}, NUMBER: S_NUMBER, SPACE: S_SPACE, WHITE: S_WHITE, QUOTE: S_QUOTE,
             OTHER: S_OTHER, END: S_START}
    joined = {**{c: S_LETTER for c in LETTERS}, NUMBER: S_NUMBER, QUOTE: S_OTHER, OTHER: S_OTHER}
    runs = {SPACE: S_RUN_SPACE, WHITE: S_RUN_WHITE}
    goes_on = {
        S_SPACE: joined | runs, S_LETTER: {c: S_LETTER for c in LETTERS}, S_NUMBER: {NUMBER: S_NUMBER},
        S_OTHER: {QUOTE: S_OTHER, OTHER: S_OTHER}, S_WHITE: runs, S_RUN_SPACE: runs, S_RUN_WHITE: runs,
        S_QUOTE: {L_STMD: S_DONE, L_RV: S_RV, L_L: S_LL, QUOTE: S_OTHER, OTHER: S_OTHER}, S_RV: {L_E: S_DONE}, S_LL: {L_L: S_DONE},
    }
    for state in range(12):
        for c in range(11):
            if c in goes_on.get(state, {}):
                nxt[state, c] = goes_on[state][c]
            elif state == S_RUN_SPACE and c != END:  # the run's last space begins what follows
                nxt[state, c], out[state, c] = joined[c], BEFORE
            elif state in (S_RV, S_LL) and c in LETTERS:  # no contraction: the letter began a word
                nxt[state, c], out[state, c] = S_LETTER, BEFORE
            else:
                late = state in (S_RV, S_LL) or (state == S_RUN_WHITE and c != END)
                nxt[state, c], out[state, c] = begin[c], HERE + BEFORE * late
    return nxt, out


@functools.cache
def char_classes(path: str) -> np.ndarray:
    """The class of every code point, by where the tokenizer's splitter cuts before it."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"] or {}
    if pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or spec["normalizer"] or spec["post_processor"]:
        raise ValueError("only plain byte-level BPE tokenizers are compiled")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("added tokens with white space rules aren't compiled")
    splitter = Tokenizer.from_file(path).pre_tokenizer
    probes = {LETTER: "a", NUMBER: "1", OTHER: "!"}
    guess = {"L": LETTER, "N": NUMBER}
    kind = np.full(0x110000, WHITE, np.uint8)
    blocks: dict[int, list[str]] = {c: [] for c in probes}
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000:
            blocks[guess.get(unicodedata.category(chr(point))[0], OTHER)].append(chr(point))
    todo = [(found, block[a:a + 4096]) for found, block in blocks.items() for a in range(0, len(block), 4096)]
    while todo:
        found, block = todo.pop()
        likely = [found] if len(block) > 1 else probes
        # a character of the probe's class stays with it, whatever Python's tables say
        right = next((c for c in likely if len(splitter.pre_tokenize_str(probes[c] + "".join(block))) == 1), None)
        if right is not None:
            kind[[ord(c) for c in block]] = right
        elif len(block) > 1:
            todo += [(found, block[:len(block) // 2]), (found, block[len(block) // 2:])]
    for chars, found in (("stmd", L_STMD), ("rv", L_RV), ("e", L_E), ("l", L_L), (" ", SPACE), ("'", QUOTE)):
        kind[[ord(c) for c in chars]] = found
    return kind


def begins(classes: np.ndarray, nxt: np.ndarray, out: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Positions at which a pre-token begins, END positions included."""
    n = len(classes)
    lanes = -(-n // chunk)
    grid = np.full(lanes * chunk, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)
    states, kinds = nxt.shape
    flat_next, flat_out = nxt.ravel().astype(np.intp), out.ravel()
    # chunk maps: all start states side by side, until they have met
    at = np.repeat(np.arange(states, dtype=np.intp)[:, None], lanes, axis=1)
    told, step = [], 0
    while step < chunk and (step < 2 or (at != at[:1]).any()):
        cell = at * kinds + grid[step]
        told.append(flat_out[cell])
        at = flat_next[cell]
        step += 1
    emit = np.empty((chunk, lanes), np.int8)
    met = at[0].copy()
    for k in range(step, chunk):
        cell = met * kinds + grid[k]
        emit[k] = flat_out[cell]
        met = flat_next[cell]
    ends = np.repeat(met[None], states, axis=0) if step < chunk else at
    # prefix scan of the maps by doubling: after round r a map spans 2**r chunks
    maps, span = ends, 1
    while span < lanes:
        ahead = maps.copy()
        ahead[:, span:] = np.take_along_axis(maps[:, span:], maps[:, :-span], axis=0)
        maps, span = ahead, 2 * span
    start = np.concatenate([[S_START], maps[S_START, :-1]])
    pick = np.arange(lanes)
    for k in range(step):
        emit[k] = told[k][start, pick]
    line = emit.T.ravel()[:n]
    here = (line & HERE).astype(bool)
    here[:-1] |= (line[1:] & BEFORE).astype(bool)
    return np.flatnonzero(here)


class Counter:
    """Counts the tokens of texts; holds the compiled tables."""

    def __init__(self, path: str, kinds: np.ndarray):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.kinds, self.merges = kinds, MergeTransducer(spec["model"])
        self.next, self.out = compile_splitter()
        self.table: dict[str, int] = {}

    def _emitted(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token; new ones run through the transducer of the merges."""
        found = list(map(self.table.get, words))
        if None in found:
            if len(self.table) > TABLE_LIMIT:
                self.table.clear()
            new = [w for w in dict.fromkeys(words) if w not in self.table]
            for w in new:
                self.table[w] = self.merges.tokens(w.encode())
            found = list(map(self.table.__getitem__, words))
        return found

    def _group(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text; no text holds a special string."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        line = "\n".join(texts) + "\n"  # a place for END after every text
        classes = self.kinds[np.frombuffer(line.encode("utf-32-le"), np.uint32)]
        stops = np.cumsum(lengths + 1) - 1
        classes[stops] = END
        cuts = begins(classes, self.next, self.out)
        places = cuts.tolist()
        is_end = classes[cuts] == END
        first = np.concatenate([[True], is_end[:-1]])
        words = [line[a:b] for a, b in zip(places, places[1:], strict=False)]
        words.append("")
        emitted = np.zeros(len(cuts), np.int64)
        real = np.flatnonzero(~is_end)
        emitted[real] = self._emitted([words[k] for k in real.tolist()])
        return np.add.reduceat(emitted, np.flatnonzero(first))

    def counts(self, texts: list[str]) -> np.ndarray:
        parts, owner = [], []
        total = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            pieces = [text]
            for s in self.specials:
                if s in text:
                    split = [p.split(s) for p in pieces]
                    total[k] += sum(len(p) - 1 for p in split)
                    pieces = [x for p in split for x in p]
            parts += pieces
            owner += [k] * len(pieces)
        a = 0
        while a < len(parts):  # groups of bounded size, or one longer text
            b, size = a, 0
            while b < len(parts) and (b == a or size + len(parts[b]) <= GROUP):
                size += len(parts[b])
                b += 1
            np.add.at(total, owner[a:b], self._group(parts[a:b]))
            a = b
        return total


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """Per row: ``id_col, n_bytes, n_tokens, over_limit``.

    ``path`` names the tokenizer file on every worker. The table of character
    classes that is broadcast has one byte per code point, whatever the data.
    """
    spark = df.sparkSession
    small_batches(spark)
    kinds = spark.sparkContext.broadcast(char_classes(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once_a_worker(f"counter {path}", lambda: Counter(path, kinds.value))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.counts(texts), pa.int64()), batch.column(2)],
                                             names=["id", "n_tokens", "n_bytes"])

    text = F.col(text_col).cast("string")
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, n_bytes long")
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
