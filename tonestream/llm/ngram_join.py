"""The groups that an n-gram Jaccard join makes, with vertical partitioning.

A document is the set of its distinct ``n``-word shingles; two documents link when their
Jaccard similarity is at least ``percent`` hundredths. ``annotate`` and ``keep`` give the groups that all links make,
exactly, without finding all links: sets that are in one group already aren't compared again. ``links`` gives all links between
different sets, and the number of links of each row. Equal sets are one class, whose copies are never expanded into pairs.

Method:

1. One pass computes every set's size and hash, and counts shingles map-side: those met
   more than once in a few million are summed over all tasks. The global order puts the
   frequent ones (more than ``HOT`` sightings, at most ``2**20`` of them) last, by frequency, the others before, by hash.
2. The first fragment of a set in that order is its prefix: linked sets share a shingle in both
   prefixes. Prefix shingles meet in a bucket each, with their position; a pair is a candidate only where
   what is left of both sets behind the shared position can still reach the similarity.
3. Candidates are verified by vertical partitioning, twice: which of many narrow fragments a set falls into is a
   bitmap, and the fragments that only one of a pair falls into bound its overlap and leave out most pairs; for the others
   sets are cut into ``FRAGMENTS`` fragments, the overlap is counted in each by itself, and the counts are summed per pair.
4. No bucket expands into all its pairs. First each bucket's sets meet only two of it; then, where
   several groups are left in a bucket, the sets outside its largest group meet those of other groups. After that
   each pair that could link was compared or is in one group already, so the groups are exact.

Shingles and sets are told apart by 64-bit hashes (sets also by size).

Defined results: null text counts as empty; a text with fewer than ``n`` words is one shingle of
all its words; a text without words has an empty set and is a group of its own;
rows that repeat share a class; null ids take part, and name a group only if it has no other;
an empty table gives an empty result; ``keep`` passes all columns through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.byte_hash import FIRST, SECOND, Ranges, mix
from tonestream.llm.common import fresh, key_of, materialize, small_batches, text_or_empty
from tonestream.llm.components import components

WORDS, PERCENT, HOT, FRAGMENTS = 5, 80, 32, 8
#: Most frequent shingles that are broadcast: a shingle must make up this share of all to count as one.
HOT_LIMIT = 1 << 20
#: Shingles that a task counts together.
COUNTED = 1 << 21
#: Most 64-bit words of a set's sketch, and of the coarse one folded from it.
FINEST, COARSE = 1 << 14, 16
#: Bytes of text that are hashed together.
STRETCH = 1 << 20
#: Buckets up to this size are searched for sets that can't link with any other in it.
SEARCHED = 4096
#: Most class ids whose texts are looked up by a broadcast; beyond it by a shuffle.
BROADCAST_IDS = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the bytes begins, and its hash with A-Z lower-cased."""
    begins, hashed, a = [], [], 0
    while a < len(data):
        b = a + STRETCH
        while b < len(data) and not SPACE[data[b]]:  # cut at white space only
            ahead = np.flatnonzero(SPACE[data[b:b + STRETCH]])
            b = b + int(ahead[0]) if len(ahead) else b + STRETCH
        part = LOWER[data[a:b]]
        edges = np.flatnonzero(np.diff(np.r_[False, ~SPACE[part], False].astype(np.int8)))
        begins.append(edges[::2] + a)
        hashed.append(Ranges(part, FIRST).hash(edges[::2], edges[1::2]))
        a = b
    return (np.concatenate(begins), np.concatenate(hashed)) if begins else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles."""
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins, hashed = word_hashes(np.frombuffer(b" ".join(texts), np.uint8))
    upto = np.searchsorted(begins, ends)
    since = np.r_[0, upto[:-1]]
    many = np.maximum(upto - since, 0)
    line = Ranges(hashed, SECOND)
    first = np.arange(max(0, len(hashed) - words + 1))
    full = line.hash(first, first + words)
    short = np.flatnonzero((many > 0) & (many < words))
    alone = dict(zip(short.tolist(), line.hash(since[short], upto[short]) ^ many[short].astype(np.uint64), strict=True))
    out = []
    for i, (a, b) in enumerate(zip(since.tolist(), upto.tolist(), strict=True)):
        if b - a >= words:
            own = np.sort(full[a:b - words + 1])
            out.append(own[np.r_[True, own[1:] != own[:-1]]])
        else:
            out.append(np.array([alone[i]] if i in alone else [], np.uint64))
    return out


def set_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """A hash of each set, as signed 64-bit numbers; 0 for empty ones."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.zeros(len(sets), np.uint64)
    filled = np.flatnonzero(sizes)
    if len(filled):
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(mix(np.concatenate(sets) ^ np.uint64(SECOND)), (np.cumsum(sizes) - sizes)[filled])
            out[filled] = mix(sums + sizes[filled].astype(np.uint64) * np.uint64(FIRST))
    return out.view(np.int64)


def sketches(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set a bitmap of the fragments of the hash order that it falls into, four or more fragments a
    shingle up to ``FINEST`` words of 64, as signed 64-bit numbers."""
    out = []
    for own in sets:
        words = min(FINEST, 1 << max(2, (len(own) // 16).bit_length()))
        bits = np.zeros(64 * words, np.uint8)
        bits[(own & np.uint64(64 * words - 1)).astype(np.int64)] = 1
        out.append(np.packbits(bits, bitorder="little").view(np.int64))
    return out


def coarse(sketch: np.ndarray) -> np.ndarray:
    """A sketch folded to ``COARSE`` words."""
    return np.bitwise_or.reduce(sketch.reshape(-1, COARSE), axis=0) if len(sketch) > COARSE else sketch


def _sets(column: pa.Array, words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sets of a column of texts, in groups of bounded size, with the row of the group's first."""
    texts = [t.encode() if t else b"" for t in column.to_pylist()]
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= STRETCH):
            size += len(texts[b])
            b += 1
        yield a, shingle_sets(texts[a:b], words)
        a = b


def _survey(rows: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: ``id, k, s, n, sketch, coarse`` of each document, and ``t, seen`` of shingles met again in a task."""

    def count(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        t, seen = np.unique(np.concatenate(found), return_counts=True)
        return t[seen > 1].view(np.int64), seen[seen > 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        names = ["id", "k", "s", "n", "sketch", "coarse", "t", "seen"]

        def counted(kind: pa.DataType) -> pa.RecordBatch:
            t, seen = count(waiting)
            none = [pa.nulls(len(t), x) for x in (kind, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays([*none, pa.array(t), pa.array(seen)], names=names)

        for batch in batches:
            s, n, bins = [], [], []
            for _, sets in _sets(batch.column(2), words):
                s.append(set_hashes(sets))
                bins += sketches(sets)
                n += map(len, sets)
                waiting += sets
                size += sum(map(len, sets))
            s = np.concatenate(s) if s else np.zeros(0, np.int64)
            none = [pa.nulls(len(s), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.int64()), pa.array(n, pa.int64()),
                                                   *[pa.array(x, pa.list_(pa.int64())) for x in (bins, [coarse(b) for b in bins])], *none], names=names)
            if size > COUNTED:
                yield counted(batch.column(0).type)
                waiting, size = [], 0
        if size:
            yield counted(batch.column(0).type)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, k long, s long, n long, sketch array<long>, coarse array<long>, t long, seen long")


def _prefixes(rows: DataFrame, hot: tuple[np.ndarray, np.ndarray], words: int, percent: int) -> DataFrame:
    """``t, s, n, i``: the prefix shingles of each set, with their position in the order; a set once a task."""
    sent = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, often = sent.value
        met: set[int] = set()
        for batch in batches:
            cols = [], [], [], []
            for _, sets in _sets(batch.column(2), words):
                named = zip(set_hashes(sets).tolist(), sets, strict=True)
                new = [(s, own) for s, own in named if len(own) and s not in met and not met.add(s)]
                if not new:
                    continue
                every = np.concatenate([own for _, own in new])
                at = np.minimum(np.searchsorted(tokens, every), max(0, len(tokens) - 1))
                common = np.where(tokens[at] == every, often[at], 0) if len(tokens) else np.zeros(len(every), np.int64)
                a = 0
                for s, own in new:
                    n = len(own)
                    wanted, seen = n - -(-percent * n // 100) + 1, common[a:a + n]
                    a += n
                    first = own[seen == 0][:wanted]  # by hash already; the frequent ones follow by their number
                    if len(first) < wanted:
                        late = np.flatnonzero(seen)
                        first = np.r_[first, own[late[np.lexsort((own[late], seen[late]))[:wanted - len(first)]]]]
                    for col, value in zip(cols, (first.view(np.int64), np.full(wanted, s), np.full(wanted, n), np.arange(wanted)), strict=True):
                        col.append(value)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols], names=["t", "s", "n", "i"])

    return rows.mapInArrow(run, "t long, s long, n long, i long")


def _partners(rows: np.ndarray, percent: int) -> np.ndarray:
    """Which rows (t, s, n, i), whole buckets in order, can link with another of their bucket."""
    start = np.flatnonzero(np.r_[True, rows[1:, 0] != rows[:-1, 0]]) if len(rows) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[start, len(rows)])
    left, n = (rows[:, 2] - rows[:, 3]) * (100 + percent), rows[:, 2] * percent
    keep = np.zeros(len(rows), bool)
    for m in np.unique(sizes[sizes > 1]).tolist():
        at = start[sizes == m]
        together = max(1, (1 << 20) // (m * m))
        for k in range(0, len(at), together):
            own = at[k:k + together, None] + np.arange(m)
            for block in range(0, m, 256):  # a part of a large bucket's rows against all of them
                some = own[:, block:block + 256]
                fits = np.minimum(left[some][:, :, None], left[own][:, None]) >= n[some][:, :, None] + n[own][:, None]
                fits &= some[:, :, None] != own[:, None]
                keep[some] = fits.any(axis=2)
    return keep


def _shared(prefixes: DataFrame, percent: int) -> DataFrame:
    """The rows of buckets with more than one set, each set once, without those that can't link in it.

    Buckets of more than ``SEARCHED`` sets pass whole, as they come.
    """
    names = ["t", "s", "n", "i"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = np.zeros((0, 4), np.int64), False  # the last bucket so far, or its last row if it is large
        for batch in batches:
            rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
            rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]]
            cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            whole, held = rows[:cut], rows[cut:]
            out = []
            if large:  # its first row has been passed on already
                end = int(np.searchsorted(rows[:, 0], rows[0, 0], side="right"))
                out.append(rows[1:end])
                if end == len(rows):
                    whole, held = rows[:0], rows[-1:]
                else:
                    whole, large = rows[end:cut], False
            out.append(whole[_partners(whole, percent)])
            if not large and len(held) > SEARCHED:
                out.append(held)
                held, large = held[-1:], True
            out = np.concatenate(out)
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(out[:, j]) for j in range(4)], names=names)
        if not large and len(held):
            out = held[_partners(held, percent)]
            yield pa.RecordBatch.from_arrays([pa.array(out[:, j]) for j in range(4)], names=names)

    return prefixes.repartition("t").sortWithinPartitions("t", "s").mapInArrow(run, "t long, s long, n long, i long")


def _candidates(left: DataFrame, right: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``x, y`` (x smaller) of a bucket that can still be similar enough; where the
    rows have groups, only of different groups, only where the buckets before differ, and only those whose coarse
    sketches allow it."""
    grouped = "g" in right.columns
    b = right.select(*[F.col(c).alias(c + "2") for c in right.columns])
    enough = percent * (F.col("n") + F.col("n2"))
    meet = (F.col("t") == F.col("t2")) & (F.col("s") != F.col("s2")) & (
        F.least(F.col("n") - F.col("i"), F.col("n2") - F.col("i2")) * (100 + percent) >= enough)
    if grouped:
        meet = meet & (F.col("g") != F.col("g2")) & F.coalesce(F.col("before") != F.col("before2"), F.lit(True)) & (
            (F.col("n") - _missing("coarse", "coarse2")) * (100 + percent) >= enough)
    pairs = left.join(b, meet)
    x = F.struct("s", "n")
    y = F.struct(F.col("s2").alias("s"), F.col("n2").alias("n"))
    return pairs.select(F.least(x, y).alias("p"), F.greatest(x, y).alias("q")).select(
        F.col("p.s").alias("x"), F.col("p.n").alias("nx"), F.col("q.s").alias("y"), F.col("q.n").alias("ny")).distinct()


def _missing(a: str, b: str) -> Column:
    """At least how many shingles of the set of sketch ``a`` the set of sketch ``b`` doesn't have: fragments that only
    ``a`` falls into. A finer sketch is folded to the coarser one's fragments."""
    least = F.least(F.size(a), F.size(b))

    def folded(c: str) -> Column:
        halves = lambda x: F.zip_with(F.slice(x, F.lit(1), least), F.slice(x, least + 1, least), lambda p, q: p.bitwiseOR(q))
        # sizes of sets that can link differ by less than twice, so one fold is enough; else there is no bound
        return F.when(F.size(c) == least, F.col(c)).when(F.size(c) == 2 * least, halves(F.col(c)))

    alone = F.zip_with(folded(a), folded(b), lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
    return F.coalesce(F.aggregate(alone, F.lit(0), lambda total, m: total + m), F.lit(0))


def _sketches(of: DataFrame, sets: DataFrame, kind: str = "sketch") -> DataFrame:
    """``s`` and the sketch of the sets ``s`` in ``of``."""
    used = materialize(of.select("s").distinct(), "used")
    few = used.count() <= BROADCAST_IDS
    return materialize(sets.select("s", kind).join(F.broadcast(used) if few else used, "s", "left_semi").dropDuplicates(["s"]), "sketches")


def _reachable(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches allow the similarity, by the coarse ones and then the others."""
    for kind in ("coarse", "sketch"):
        known = _sketches(pairs.select(F.col("x").alias("s")).unionAll(pairs.select("y")), sets, kind)
        both = pairs.join(known.alias("a"), F.expr("x = a.s")).join(known.alias("b"), F.expr("y = b.s"))
        fits = (F.col("nx") - _missing(f"a.{kind}", f"b.{kind}")) * (100 + percent) >= percent * (F.col("nx") + F.col("ny"))
        pairs = materialize(both.where(fits).select("x", "nx", "y", "ny"), "pairs")
    return pairs


def _verify(pairs: DataFrame, rows: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``x, y`` that link, by overlaps counted per fragment and summed."""
    used = pairs.select(F.col("x").alias("s")).unionAll(pairs.select(F.col("y").alias("s"))).distinct()
    wanted = materialize(used.join(classes, "s").select(F.col("id").alias("i"), F.col("k").alias("j")), "wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = rows.join(wanted, F.col("id").eqNullSafe(F.col("i")) & (F.col("k") == F.col("j")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, part, out = [], [], []
            for _, sets in _sets(batch.column(0), words):
                for whole, own in zip(set_hashes(sets).tolist(), sets, strict=True):
                    cut = np.searchsorted(own, (np.arange(1, FRAGMENTS) * (2**64 // FRAGMENTS)).astype(np.uint64))
                    for f, tokens in enumerate(np.split(own, cut)):
                        if len(tokens):
                            s.append(whole), part.append(f), out.append(tokens.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(part, pa.int32()), pa.array(out, pa.list_(pa.int64()))],
                                             names=["s", "part", "tokens"])

    parts = materialize(texts.mapInArrow(run, "s long, part int, tokens array<long>").dropDuplicates(["s", "part"]), "fragments")
    # both joins use the same key, so the fragments are dealt out once
    each = pairs.withColumn("f", F.explode(F.array(*[F.lit(f) for f in range(FRAGMENTS)])))
    met = each.join(parts.alias("b"), F.expr("y = b.s and f = b.part")).select("x", "y", "nx", "ny", "f", F.col("b.tokens").alias("theirs"))
    met = met.join(parts.alias("a"), F.expr("x = a.s and f = a.part")).select(
        "x", "y", "nx", "ny", F.size(F.array_intersect("a.tokens", "theirs")).alias("o"))
    summed = met.groupBy("x", "y", "nx", "ny").agg(F.sum("o").alias("o"))
    return materialize(summed.where(F.col("o") * 100 >= percent * (F.col("nx") + F.col("ny") - F.col("o"))).select("x", "y"), "links")


def _undecided(buckets: DataFrame, ends: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of buckets, with their group ``g``, that may hold pairs neither compared nor grouped yet.

    A bucket's two ``ends`` were compared with all of it, so they are left out, and then buckets of one group.
    """
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    rest = buckets.join(ends.select("t", "s"), ["t", "s"], "left_anti")
    rest = materialize(rest.join(roots.select(F.col("node").alias("s"), "root"), "s", "left").select(
        "t", "s", "n", "i", F.coalesce("root", "s").alias("g")), "rest")
    mixed = materialize(rest.groupBy("t").agg(F.min("g").alias("low"), F.max("g").alias("high")).where("low <> high").select("t"), "mixed")
    return materialize(rest.join(mixed, "t"), "undecided")


def _surveyed(df: DataFrame, id_col: str, text_col: str, words: int, percent: int, hot: int) -> tuple[DataFrame, ...]:
    """The rows (``id, k, text``), documents (``id, k, s, n``), sets with sketches, prefix buckets and a document of each set."""
    small_batches(df.sparkSession)
    text = text_or_empty(text_col)
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k"), text.alias("text"))
    survey = materialize(_survey(rows, words), "survey")
    docs = survey.where("n is not null").select("id", "k", "s", "n")
    sets = survey.where("n > 0").select("s", "sketch", "coarse")
    total = docs.agg(F.sum("n")).first()[0] or 0
    frequent = survey.where("seen is not null").groupBy("t").agg(F.sum("seen").alias("seen")).where(
        F.col("seen") > max(hot, total // HOT_LIMIT)).toPandas()  # at most HOT_LIMIT rows
    tokens = frequent["t"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    order = (tokens[order], frequent["seen"].to_numpy(np.int64)[order])
    buckets = materialize(_shared(_prefixes(rows, order, words, percent), percent), "buckets")
    classes = materialize(docs.where("n > 0").groupBy("s").agg(F.first("id").alias("id"), F.first("k").alias("k")), "classes")
    return rows, docs, sets, buckets, classes


def _with_before(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of buckets with their coarse sketch and the bucket before: a pair whose sets both come from one earlier
    bucket meets there, not again."""
    before = F.lag("t").over(Window.partitionBy("s").orderBy("i"))
    return materialize(left.join(_sketches(left, sets, "coarse"), "s").withColumn("before", before), "undecided")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
           hot: int = HOT) -> DataFrame:
    """``id, k, n, g, first``: per row its id, text hash, set size, group (null without words) and the group's smallest id."""
    rows, docs, sets, buckets, classes = _surveyed(df, id_col, text_col, words, percent, hot)
    # every set with two of its bucket: the one with the fewest rare shingles, nearest to what all share, and any one
    ends = [buckets.groupBy("t").agg(F.min(F.struct(*key)).alias("m")).select("t", "m.s", "m.n", "m.i") for key in (("i", "s", "n"), ("s", "n", "i"))]
    ends = materialize(ends[0].unionAll(ends[1]).distinct(), "ends")
    pairs = materialize(_candidates(buckets, ends, percent), "pairs")
    links = _verify(_reachable(pairs, sets, percent), rows, classes, words, percent)
    # where several groups are left in a bucket, the sets outside its largest with all of other groups
    left = _undecided(buckets, ends, links)
    left = _with_before(left, sets)
    sizes = left.groupBy("t", "g").agg(F.count(F.lit(1)).alias("size"))
    lead = materialize(sizes.groupBy("t").agg(F.max(F.struct("size", "g")).alias("m")).select("t", F.col("m.g").alias("main")), "lead")
    outside = left.join(lead, "t").where("g <> main").drop("main")
    pairs = materialize(_candidates(outside, left, percent), "pairs")
    links = links.unionAll(_verify(_reachable(pairs, sets, percent), rows, classes, words, percent))
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    member = docs.join(roots.select(F.col("node").alias("s"), "root"), "s", "left").select(
        "id", "k", "n", F.when(F.col("n") > 0, F.coalesce("root", "s")).alias("g"))
    member = materialize(member, "members")
    # written, so that the rows of one very large group can be split in the join
    names = materialize(member.where("g is not null").groupBy("g").agg(F.min("id").alias("least")), "names")
    return member.join(names, "g", "left").select("id", "k", "n", "g", F.when(F.col("g").isNull(), F.col("id")).otherwise(F.col("least")).alias("first"))


def annotate(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: ``id_col, n_shingles, component_id``."""
    return groups(df, id_col=id_col, **options).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("first").alias("component_id"))


def links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT,
          hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """The join itself, as two tables: all links between different sets, and which rows have a set.

    The first has ``left, right``, the smallest ids of two linked sets, each pair once (an id that comes with several texts can
    stand for several sets; ``left_set, right_set`` tell them apart). The second has per row ``id_col, n_shingles, set, class_id, n_equal,
    n_links``: its set (null without words), the smallest id that has this set, how many rows have it, this one included, and how many other rows
    it links with, those with an equal set included. Unlike ``annotate`` this compares all pairs of a bucket that position
    and coarse sketch leave, so it costs more where families of near copies are large, as its output does.
    """
    rows, docs, sets, buckets, classes = _surveyed(df, id_col, text_col, words, percent, hot)
    left = _with_before(buckets.withColumn("g", F.col("s")), sets)
    found = _verify(_reachable(materialize(_candidates(left, left, percent), "pairs"), sets, percent), rows, classes, words, percent)
    equal = materialize(docs.where("n > 0").groupBy("s").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_equal")), "equal")
    both = found.unionAll(found.select(F.col("y").alias("x"), F.col("x").alias("y")))
    reached = both.join(equal.select(F.col("s").alias("y"), "n_equal"), "y").groupBy("x").agg(F.sum("n_equal").alias("others"))
    known = materialize(equal.join(reached.withColumnRenamed("x", "s"), "s", "left"), "linked")
    members = docs.withColumn("s", F.when(F.col("n") > 0, F.col("s"))).join(known, "s", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("s").alias("set"), "class_id", F.coalesce("n_equal", F.lit(0)).alias("n_equal"),
        F.coalesce(F.col("n_equal") - 1 + F.coalesce("others", F.lit(0)), F.lit(0)).alias("n_links"))
    a, b = (equal.select(F.col("s").alias(c), F.col("class_id").alias(f"id_{c}")) for c in ("x", "y"))
    first, second = F.struct(F.col("id_x").alias("id"), F.col("x").alias("s")), F.struct(F.col("id_y").alias("id"), F.col("y").alias("s"))
    pairs = found.join(a, "x").join(b, "y").select(F.least(first, second).alias("p"), F.greatest(first, second).alias("q"))
    return pairs.select(F.col("p.id").alias("left"), F.col("q.id").alias("right"), F.col("p.s").alias("left_set"), F.col("q.s").alias("right_set")), members


def keep(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group, that with the smallest id, with all its columns; rows without words all stay."""
    found = groups(df, id_col=id_col, text_col=text_col, **options)
    named = found.where(F.col("g").isNotNull() & F.col("id").eqNullSafe(F.col("first"))).groupBy("g").agg(
        F.first("id").alias("id"), F.min("k").alias("k")).select(key_of(F.col("id")).alias("key"), "k", F.lit(True).alias("words"))
    bare = found.where("g is null").select(key_of(F.col("id")).alias("key"), "k", F.lit(False).alias("words")).distinct()
    (row,) = fresh(df, "row")
    rows = df.select(F.struct("*").alias(row), key_of(F.col(id_col)).alias("key"), F.xxhash64(text_or_empty(text_col)).alias("k"))
    once = Window.partitionBy("key", "k").orderBy("words")
    return rows.join(named.unionAll(bare), ["key", "k"]).withColumn("nth", F.row_number().over(once)).where("nth = 1 or not words").select(f"{row}.*")
