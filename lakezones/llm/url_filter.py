"""URL filter: rules and host lists decided by Bloom filter cascades.

A cascade answers set membership exactly for every key of a fixed universe.
Level 0 encodes the listed keys; level 1 the keys of the universe that level 0
reports by mistake; level 2 the listed keys that level 1 reports by mistake;
and so on until a level makes no mistake.  The universe is complete: all keys
that the corpus itself asks for (every url's candidate rule keys and its host
key), reduced to distinct keys with a map-side combine, so a hot host is one key.

Filters are bit arrays built by ``bit_or`` aggregates.  A list is dealt by a hash of its keys to as many shards as
keep each one's levels within ``max_bits``; all shards are built together, level by level.  The shards of all lists lie one after the
other in a single array that the pages' scan sees as one scalar subquery, so the probe needs no
join.  Where that array would pass ``wave_bits``, the pages go through several passes, each with the next shards, and
carry the answers so far: a task holds a bounded array however long the lists are.  DataFrame functions only.
"""

from __future__ import annotations

import functools
import itertools
import math
import string
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

MAX_BITS = 1 << 25  # 4 MB of filter for a shard
WAVE_BITS = 1 << 28  # 32 MB of filters for a pass over the pages
LEAST_BITS = 1 << 12  # a shard has at least this room, one word for each of 64 levels
TAIL_HASHES = 12  # of the late levels, which hold few keys: they soon make no mistake


def with_host_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a null url or one without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    raw = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    return (pages.withColumn("_rest", rest).withColumn("_raw", raw)
            .withColumn("host", F.translate("_raw", string.ascii_uppercase, string.ascii_lowercase))
            .withColumn("path", F.regexp_extract(F.expr("substring(_rest, length(_raw) + 1)"), r"^[^?#]*", 0))
            .drop("_rest", "_raw"))


@dataclass(frozen=True)
class RuleShape:
    """Label counts of the rules' hosts and lengths of their paths: the only keys worth asking for."""

    labels: tuple[int, ...]
    lengths: tuple[int, ...]

    @classmethod
    def of(cls, rules: DataFrame) -> "RuleShape":
        row = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("a"),
                        F.collect_set(F.length("path")).alias("b")).first()
        return cls(tuple(sorted(row["a"], reverse=True)), tuple(sorted(row["b"], reverse=True)))

    def candidates(self) -> list[Column]:
        """Keys ``host suffix || path prefix`` that a rule of this shape could have; null where the url is too short."""
        labels = F.split("host", r"\.")
        return [F.when((F.size(labels) >= n) & (F.length("path") >= m) & (F.col("host") != ""),
                       F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring("path", 1, m)))
                for n in self.labels for m in self.lengths]


def host_key(host: Column) -> Column:
    """Key of a whole host; rule keys always hold a ``/`` or no ``=``, so the two kinds never meet."""
    return F.concat(F.lit("="), host)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards)).cast("int") if shards > 1 else F.lit(0)


@dataclass
class Level:
    words: DataFrame  # shard, words
    bits: int  # of a shard
    hashes: int

    def mistaken(self, keys: DataFrame, number: int, shards: int, wave_bits: int, label: str) -> DataFrame:
        """Those of ``keys`` that the level reports; stored."""
        a_wave, found = max(1, wave_bits // self.bits), []
        for lo in range(0, shards, a_wave):
            shard = shard_of(F.col("key"), shards)
            words = one_array([self.words.where(F.col("shard").between(lo, lo + a_wave - 1))], f"{label}-wave")
            asked = keys.where(shard.between(lo, lo + a_wave - 1)).withColumn("_filter", words.scalar())
            start = (shard - F.lit(lo)) * F.lit(self.bits // 64)
            hit = might_contain(F.col("key"), F.col("_filter"), start, F.lit(number), F.lit(self.bits), F.lit(self.hashes))
            found.append(stored(asked.where(hit).select("key"), label))
        return functools.reduce(DataFrame.unionByName, found)


class Cascade:
    """Exact membership of universe keys in one list."""

    def __init__(self, levels: list[Level], shards: int = 1):
        self.levels = levels
        self.shards = shards
        self.shard_words = sum(v.bits for v in levels) // 64

    @classmethod
    def build(cls, universe: DataFrame, listed: DataFrame, label: str, max_bits: int = MAX_BITS,
              wave_bits: int = WAVE_BITS) -> "Cascade":
        """``universe``: distinct non-null ``key``; ``listed``: column ``key``."""
        listed = listed.select("key").where("key is not null").distinct()
        marked = stored(universe.join(listed.withColumn("_in", F.lit(True)), "key", "left")
                        .select("key", F.coalesce("_in", F.lit(False)).alias("listed")), f"{label}-universe")
        n, r = marked.agg(F.count("*"), F.coalesce(F.sum(F.col("listed").cast("long")), F.lit(0))).first()
        if not r:
            return cls([])
        rate = min(0.5, r * math.sqrt(0.5) / max(n - r, 1))
        limit = max(max_bits, LEAST_BITS)
        # every level after the first holds about 0.7 times the keys of the one before, at 1 / ln 2 bits each
        shards = math.ceil(r * (3 - math.log2(rate)) / math.log(2) / (0.75 * limit))
        while True:
            levels = cls._levels(marked, shards, rate, limit, wave_bits, label)
            if levels:
                return cls(levels, shards)
            shards *= 2

    @staticmethod
    def _levels(marked: DataFrame, shards: int, rate: float, limit: int, wave_bits: int, label: str) -> list[Level]:
        """Levels until one makes no mistake in any shard; none if a shard would pass ``limit`` bits."""
        inside, outside = marked.where("listed").select("key"), marked.where("not listed").select("key")
        most, levels, spent = _fullest(inside, shards), [], 0
        for number in itertools.count():
            if number > 1 and 2 * TAIL_HASHES * most <= limit // 16:
                rate = 0.5 ** TAIL_HASHES
            hashes = max(1, round(-math.log2(rate)))
            bits = 64 * math.ceil(max(1.0, -most * math.log(rate) / math.log(2) ** 2) / 64)
            spent += bits
            if spent > limit:
                return []
            levels.append(Level(stored(bit_words(inside, number, bits, hashes, shards), f"{label}-level{number}"), bits, hashes))
            outside = levels[-1].mistaken(outside, number, shards, wave_bits, f"{label}-mistaken{number}")
            most = _fullest(outside, shards)
            if not most:
                return levels
            inside, outside, rate = outside, inside, 0.5

    def contains(self, key: Column, words: Column, first_word: int = 0, first_shard: int = 0) -> Column:
        """Membership of a key whose shard is in ``words``, where shard ``first_shard`` begins at ``first_word``.

        A key is listed if the number of levels that report it, one after the other, is odd.
        """
        base = F.lit(first_word) + (shard_of(key, self.shards) - F.lit(first_shard)) * F.lit(self.shard_words)
        starts = [0, *itertools.accumulate(v.bits // 64 for v in self.levels)]
        levels = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(starts[n]).alias("start"), F.lit(v.bits).alias("bits"), F.lit(v.hashes).alias("hashes"))
                           for n, v in enumerate(self.levels)])
        deep = F.aggregate(levels, F.lit(0), lambda d, v: F.when(
            (d == v["n"]) & might_contain(key, words, base + v["start"], v["n"], v["bits"], v["hashes"]), d + 1).otherwise(d))
        return deep % 2 == 1


def _fullest(keys: DataFrame, shards: int) -> int:
    """Keys of the fullest shard."""
    return keys.groupBy(shard_of(F.col("key"), shards).alias("shard")).count().agg(F.max("count")).first()[0] or 0


def waves(cascades: list[Cascade], wave_bits: int) -> Iterator[list[tuple[Cascade, int, int]]]:
    """The cascades' shards in order as (cascade, first, end), in lists of at most ``wave_bits`` or one shard."""
    wave, room = [], wave_bits // 64
    for c in cascades:
        at = 0
        while c.levels and at < c.shards:
            n = min(c.shards - at, max(room // c.shard_words, 0 if wave else 1))
            if n:
                wave.append((c, at, at + n))
                at, room = at + n, room - n * c.shard_words
            else:
                yield wave
                wave, room = [], wave_bits // 64
    if wave:
        yield wave


def one_array(parts: list[DataFrame], label: str) -> DataFrame:
    """One row, ``words``: the parts' arrays by (shard, place of the part); stored."""
    rows = [p.select("shard", F.lit(i).alias("i"), "words") for i, p in enumerate(parts)]
    every = functools.reduce(DataFrame.unionByName, rows).agg(F.array_sort(F.collect_list(F.struct("shard", "i", "words"))).alias("a"))
    return stored(every.select(F.expr("flatten(transform(a, x -> x.words))").alias("words")), label)


def wave_array(wave: list[tuple[Cascade, int, int]]) -> DataFrame:
    """One row, ``words``: the wave's shards one after the other, each with all its levels."""
    parts = [one_array([v.words.where(F.col("shard").between(lo, hi - 1)) for v in c.levels], "url-shards").withColumn("shard", F.lit(i))
             for i, (c, lo, hi) in enumerate(wave)]
    return parts[0].select("words") if len(parts) == 1 else one_array(parts, "url-filters")


def position(key: Column, level: Column, bits: Column, i: Column) -> Column:
    """The key's bit number ``i``: double hashing of two seeded 64-bit hashes."""
    m = bits.cast("long")  # reduced first: sums stay far below 2^63
    a, b = (F.pmod(F.xxhash64(key, level * 2 + seed), m) for seed in (0, 1))
    return F.pmod(a + i.cast("long") * b, m)


def bit_words(keys: DataFrame, level: int, bits: int, hashes: int, shards: int) -> DataFrame:
    """The filter's bits as an array of 64-bit words for each ``shard``."""
    n = bits // 64
    bit = keys.select(shard_of(F.col("key"), shards).alias("shard"),
                      F.explode(F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)),
                                            lambda i: position(F.col("key"), F.lit(level), F.lit(bits), i))).alias("p"))
    ones = bit.select("shard", F.expr("p div 64").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("v"))
    zeros = keys.sparkSession.range(shards * n).select(F.expr(f"cast(id div {n} as int)").alias("shard"), F.expr(f"id % {n}").alias("w"),
                                                       F.lit(0).cast("long").alias("v"))
    return (ones.unionByName(zeros).groupBy("shard", "w").agg(F.bit_or("v").alias("v"))
            .groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("w", "v"))).alias("a"))
            .select("shard", F.expr("transform(a, x -> x.v)").alias("words")))


def might_contain(key: Column, words: Column, start: Column, level: Column, bits: Column, hashes: Column) -> Column:
    """Are all of the key's bits set? An expression of one size for any number of hashes."""
    def is_set(i: Column) -> Column:
        p = position(key, level, bits, i)
        return F.getbit(F.get(words, start + F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int")) == 1

    return F.forall(F.sequence(F.lit(0), hashes - 1), is_set)


def url_verdicts(pages: DataFrame, rules: DataFrame, blocked_hosts: DataFrame, max_bits: int = MAX_BITS,
                 wave_bits: int = WAVE_BITS) -> DataFrame:
    """Judge every page: ``page_id, host, path, rule, verdict``.

    ``rules``: ``host, path, action`` (allow or block; one action a key).  A rule fits its
    host and all subdomains if the url's path starts with the rule's path; the longest
    ``host || path`` wins, and of equally long ones the greater string.  A url that no rule fits is
    blocked if its whole host is in ``blocked_hosts`` (column ``host``), else allowed.
    A null url, one without ``://`` and an empty host fit no rule and are allowed.
    Empty rules, lists or pages give no match and no rows.  Other columns are ignored;
    repeated rows stay.
    """
    parsed = with_host_path(pages.select("page_id", "url"))
    shape = RuleShape.of(rules)
    names = [f"_key{i}" for i in range(len(shape.candidates()))]
    parsed = parsed.withColumns(dict(zip(names, shape.candidates())))
    asked = parsed.select(F.explode(F.array_compact(F.array(*names, host_key(F.col("host"))))).alias("key"))
    universe = stored(asked.distinct(), "url-keys")
    keyed = rules.select(F.concat("host", "path").alias("key"), "action")
    ruled = Cascade.build(universe, keyed, "url-rules", max_bits, wave_bits)
    allowed = Cascade.build(universe, keyed.where("action = 'allow'"), "url-allow", max_bits, wave_bits)
    hosts = Cascade.build(universe, blocked_hosts.select(host_key(F.col("host")).alias("key")), "url-hosts", max_bits, wave_bits)

    judged = parsed.withColumns({"rule": F.lit(None).cast("string"), "_allowed": F.lit(False), "_blocked": F.lit(False)})
    passes = list(waves([ruled, allowed, hosts], wave_bits))
    for number, wave in enumerate(passes):
        judged = judged.withColumn("_filter", wave_array(wave).scalar())
        first_word = 0
        for cascade, lo, hi in wave:
            def told(key: Column) -> Column:
                here = shard_of(key, cascade.shards).between(lo, hi - 1)
                return key.isNotNull() & here & cascade.contains(key, F.col("_filter"), first_word, lo)

            if cascade is ruled:  # whose shards all come before those of the lists that are asked for a rule found
                found = [F.when(told(F.col(k)), F.struct(F.length(k).alias("n"), F.col(k).alias("key"))) for k in names]
                before = F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), F.col("rule").alias("key")))
                judged = judged.withColumn("rule", F.greatest(before, F.lit(None).cast("struct<n: int, key: string>"), *found)["key"])
            elif cascade is allowed:
                judged = judged.withColumn("_allowed", F.col("_allowed") | F.coalesce(told(F.col("rule")), F.lit(False)))
            else:
                judged = judged.withColumn("_blocked", F.col("_blocked") | told(host_key(F.col("host"))))
            first_word += (hi - lo) * cascade.shard_words
        judged = judged.drop("_filter")
        if number + 1 < len(passes):
            judged = stored(judged, "url-pass")
    verdict = F.when(F.col("rule").isNotNull(), F.when(F.col("_allowed"), "allow").otherwise("block")).when(F.col("_blocked"), "block")
    return judged.select("page_id", "host", "path", "rule", verdict.otherwise("allow").alias("verdict"))
