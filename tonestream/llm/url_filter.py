"""URL rules through Bloom filter cascades: exact membership without a join.

Method: a rule is a host and the beginning of a path. Every URL gives candidate keys,
one for each shape that the rules have (labels in the host, characters in the path), so
a URL has at most as many keys as there are shapes. The universe is the set of distinct keys
of the whole corpus. A cascade for a list of keys alternates:

* level 0 is a Bloom filter of the listed keys in the universe;
* level 1 holds the universe's unlisted keys that level 0 lets through;
* level 2 holds the listed keys that level 1 lets through, and so on until nothing is
  left.

A key of the universe is listed exactly if the first level that rejects it is odd,
or if none rejects it and the last level is even. Level 0 has so many bits that its false
positives number about as many as the listed keys, later levels halve what is left,
so a cascade's bits are in proportion to the listed keys times the logarithm of the universe's size
over theirs (a few MB for a million rules); that is broadcast. Keys are only ever
compared with the rules while the cascade is built, by one equi-join of distinct keys.

Verdicts come from two cascades, blocked and allowed keys; the longest listed key wins, a longer host
among equally long ones. A URL that no rule fits gets the default.

Defined results: a null URL, or one without ``://``, has an empty host and path and gets the default;
rows that repeat are judged each; a rule given twice with different verdicts is an error; without
rules everything gets the default; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonestream.llm.common import ascii_lower, literal_table, materialize

#: Hash functions of a level; bits of a level are rounded up to a multiple of 64.
LEVEL_SEED = 7919


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.instr(url, "://") > 0
    rest = F.when(has, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url))).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _shapes(rules: Sequence[str]) -> list[tuple[int, int]]:
    """(labels in the host, characters in the path) of the rules."""
    cut = [r.partition("/") for r in rules]
    return sorted({(h.count(".") + 1, len(s + p)) for h, s, p in cut})


def _key(labels: int, chars: int) -> Column:
    """The key of that shape from columns ``host`` and ``path``; null where the URL is too short for it."""
    enough = (F.size(F.split("host", r"\.")) >= labels) & (F.length("path") >= chars) & (F.col("host") != "")
    return F.when(enough, F.concat(F.substring_index("host", ".", -labels), F.substring(F.col("path"), F.lit(1), F.lit(chars))))


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), key), F.xxhash64(F.lit(2), key)


def _places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> list[np.ndarray]:
    """The bits that a key sets in a level, by double hashing."""
    a, b = h1.astype(np.uint64) + np.uint64(level) * h2.astype(np.uint64), h2.astype(np.uint64) | np.uint64(1)
    with np.errstate(over="ignore"):
        a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * LEVEL_SEED * level)
        return [((a + np.uint64(i) * b) >> np.uint64(11)) % np.uint64(bits) for i in range(hashes)]


class Cascade:
    """The levels: (bits, hashes, bitmap)."""

    def __init__(self, levels: list[tuple[int, int, np.ndarray]] | None = None) -> None:
        self.levels = levels or []

    def rejected_at(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The first level that rejects a key; the number of levels where none does."""
        at = np.full(len(h1), len(self.levels), np.int32)
        alive = np.arange(len(h1))
        for level, (bits, hashes, bitmap) in enumerate(self.levels):
            inside = np.ones(len(alive), bool)
            for place in _places(h1[alive], h2[alive], level, bits, hashes):
                inside &= (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            at[alive[~inside]] = level
            alive = alive[inside]
        return at

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return self.rejected_at(h1, h2) % 2 == 1 if self.levels else np.zeros(len(h1), bool)


def _level_size(inside: int, against: int, first: bool) -> tuple[int, int]:
    """(bits, hashes) for ``inside`` keys: false positives about as many as those, later half."""
    rate = min(0.5, max(inside, 1) * math.sqrt(0.5) / max(against, 1)) if first else 0.5
    bits = max(64, math.ceil(max(inside, 1) * -math.log(rate) / math.log(2) ** 2 / 64) * 64)
    return bits, max(1, round(-math.log2(rate)))


def build_cascade(universe: DataFrame) -> Cascade:
    """The cascade of a universe ``h1, h2, listed`` of distinct keys."""
    cascade, rest = Cascade(), universe
    sizes = {r["listed"]: r["count"] for r in rest.groupBy("listed").count().collect()}  # two rows
    level = 0
    while sizes.get(level % 2 == 0, 0):
        mine, other = sizes.get(level % 2 == 0, 0), sizes.get(level % 2 == 1, 0)
        bits, hashes = _level_size(mine, other, level == 0)

        def to_bits(frames: Iterator[pd.DataFrame], level=level, bits=bits, hashes=hashes) -> Iterator[pd.DataFrame]:
            for f in frames:
                places = np.unique(np.concatenate(_places(f["h1"].to_numpy(), f["h2"].to_numpy(), level, bits, hashes)))
                word, one = places >> np.uint64(3), np.uint64(1) << (places & np.uint64(7))
                yield pd.DataFrame({"word": word.astype(np.int64), "one": one.astype(np.int64)})

        inside = rest.where("listed" if level % 2 == 0 else "not listed").select("h1", "h2")
        words = inside.mapInPandas(to_bits, "word long, one long").groupBy("word").agg(F.bit_or("one").alias("byte"))
        bitmap = np.zeros(bits // 8, np.uint8)
        set_words = words.toPandas()  # at most bits / 8 rows
        bitmap[set_words["word"].to_numpy()] = set_words["byte"].to_numpy().astype(np.uint8)
        cascade.levels.append((bits, hashes, bitmap))
        # the other kind's keys that this level lets through go to the next one; this kind's all stay
        n = len(cascade.levels)

        def through(frames: Iterator[pd.DataFrame], n=n, level=level) -> Iterator[pd.DataFrame]:
            for f in frames:
                other_kind = (f["listed"].to_numpy() != (level % 2 == 0))
                passed = cascade.rejected_at(f["h1"].to_numpy(), f["h2"].to_numpy()) == n
                yield f[~other_kind | passed]

        rest = materialize(rest.mapInPandas(through, "h1 long, h2 long, listed boolean"), "cascade")
        sizes = {r["listed"]: r["count"] for r in rest.groupBy("listed").count().collect()}
        level += 1
    return cascade


def judge(df: DataFrame, rules: Sequence[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """Per row: ``id_col, host, path, rule, verdict``. ``rules``: (host and path, ``allow`` or ``block``)."""
    spark: SparkSession = df.sparkSession
    listed = dict(rules)
    if len(listed) < len({*rules}) or {*listed.values()} - {"allow", "block"}:
        raise ValueError("a rule has two verdicts, or one that is neither allow nor block")
    host, path = host_and_path(F.col(url_col))
    pages = df.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    shapes = _shapes([*listed])
    if not shapes:
        return pages.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = pages.select(F.explode(F.array_compact(F.array(*[_key(*s) for s in shapes]))).alias("key")).distinct()
    given = literal_table(spark, json.dumps([{"rule": r, "verdict": v} for r, v in listed.items()]), "rule string, verdict string")
    h1, h2 = _hashes(F.col("key"))
    universe = materialize(keys.join(given, F.col("key") == F.col("rule"), "left").select(h1.alias("h1"), h2.alias("h2"), "verdict"), "universe")
    cascades = [build_cascade(universe.select("h1", "h2", F.coalesce(F.col("verdict") == v, F.lit(False)).alias("listed")))
                for v in ("block", "allow")]
    sent = spark.sparkContext.broadcast([c.levels for c in cascades])

    @F.pandas_udf("array<int>")
    def verdicts(*hashes: pd.Series) -> pd.Series:
        """For each shape: 1 blocked, 2 allowed, 0 not listed."""
        out = np.zeros((len(hashes[0]), len(hashes) // 2), np.int32)
        for k in range(0, len(hashes), 2):
            h1, h2 = hashes[k].to_numpy(), hashes[k + 1].to_numpy()
            for code, levels in enumerate(sent.value, 1):
                out[Cascade(levels).listed(h1, h2), k // 2] = code
        return pd.Series(list(out))

    keyed = pages.select("*", F.array(*[_key(*s) for s in shapes]).alias("keys"))
    flat = [F.coalesce(h, F.lit(0).cast("long")) for k in range(len(shapes)) for h in _hashes(F.col("keys")[k])]
    found = keyed.withColumn("codes", verdicts(*flat))
    zipped = F.transform(F.arrays_zip("keys", "codes"), lambda z: F.struct(
        F.length(z["keys"]).alias("length"), F.length(F.substring_index(z["keys"], "/", 1)).alias("host"), z["keys"].alias("key"), z["codes"].alias("code")))
    fits = F.array_max(F.filter(zipped, lambda z: z["key"].isNotNull() & (z["code"] > 0)))
    verdict = F.when(fits["code"] == 1, "block").when(fits["code"] == 2, "allow").otherwise(default)
    return found.select(F.col("id").alias(id_col), "host", "path", fits["key"].alias("rule"), verdict.alias("verdict"))
