"""URL filters by a Bloom filter cascade, in DataFrame functions only.

Level 1 encodes the listed keys, level 2 those keys of the corpus that level 1 wrongly takes for listed, level 3 the
listed keys that level 2 takes for unlisted, and so on until a level has no false positives. Over the key universe it
was built from, membership is exact, and a query tests literals: no join, no Python.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; urls of any length are
read whole; an empty table gives an empty result; repeated rows are judged alike; the input's columns stay in the result
of ``judge``, but for those named host, path, rule, listed or verdict, which it replaces.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framegrid.llm.common import saved

#: Bits that one binary of bitmap_construct_agg holds.
PAGE_BITS = 32768
#: No level may be larger (an error says so): 2 ** 28 bits are 32 MB, once in a plan.
MAX_BITS = 1 << 28
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    seed: int
    data: bytes

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.seed * 64 + i)), F.lit(self.bits)) for i in range(self.hashes)]

    def might_hold(self, key: Column) -> Column:
        data = F.lit(self.data)  # stands once in a plan, however many hashes there are

        def is_set(at: Column) -> Column:
            byte = F.conv(F.hex(F.substring(data, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
            return F.getbit(byte, (at % 8).cast("int")) == 1

        return F.forall(F.array(*self.positions(key)), is_set)


def _level(keys: DataFrame, n: int, bits_per_key: int, hashes: int, seed: int) -> Level:
    bits = max(256, -(-n * bits_per_key // 8) * 8)
    if bits > MAX_BITS:
        raise ValueError(f"a level of {bits} bits is over the bound of {MAX_BITS}; split the list")
    plan = Level(bits, hashes, seed, b"")
    at = keys.select(F.explode(F.array(*plan.positions(F.col("key")))).alias("at"))
    pages = (
        at.groupBy((F.col("at") / PAGE_BITS).cast("int").alias("page"))
        .agg(F.bitmap_construct_agg(F.col("at") % PAGE_BITS).alias("bits"))
        .collect()
    )
    data = bytearray(-(-bits // PAGE_BITS) * PAGE_BITS // 8)
    for row in pages:  # at most MAX_BITS / PAGE_BITS rows of 4 KB
        data[row.page * PAGE_BITS // 8 : (row.page + 1) * PAGE_BITS // 8] = row.bits
    return Level(bits, hashes, seed, bytes(data[: bits // 8]))


@dataclass(frozen=True)
class BloomCascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """True for listed keys, false for the other keys of the universe."""
        answer = F.lit(True)
        for level in reversed(self.levels):
            answer = level.might_hold(key) & answer if level is self.levels[-1] else level.might_hold(key) & ~answer
        return answer if self.levels else F.lit(False)

    @staticmethod
    def build(universe: DataFrame, listed: DataFrame, bits_per_key: int = 10, hashes: int = 5) -> BloomCascade:
        """Both frames have one column ``key``. Each level counts and encodes what the level before got wrong."""
        listed = saved(listed.where("key is not null").distinct(), "listed")
        if not (n := listed.count()):
            return BloomCascade(())
        levels = [_level(listed, n, bits_per_key, hashes, 0)]
        universe = universe.where("key is not null").distinct()
        wrong = universe.where(levels[0].might_hold(F.col("key"))).join(listed, "key", "left_anti")
        inside, outside = listed, saved(wrong, "cascade")
        while n := outside.count():
            if len(levels) == 64:
                raise RuntimeError("the cascade does not end")
            levels.append(_level(outside, n, 4, 3, len(levels)))
            inside, outside = outside, saved(inside.where(levels[-1].might_hold(F.col("key"))), "cascade")
        return BloomCascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def domains(host: Column) -> Column:
    """A host and all its parent domains."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest of the (verdict, host, path) rules that fits, and its verdict; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for say, at, below in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(below))
        rule, verdict = F.when(fits, at + below).otherwise(rule), F.when(fits, say).otherwise(verdict)
    return rule, verdict


def judge(urls: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """Add host, path, rule, listed and verdict to ``urls``; a listed domain is listed with all its subdomains."""
    host, path = split_url(F.col(url))
    universe = urls.select(host.alias("host")).distinct().select(F.explode(domains(F.col("host"))).alias("key"))
    cascade = BloomCascade.build(universe, listed)
    split = urls.withColumns({"host": host, "path": path})
    rule, say = longest_rule(F.col("host"), F.col("path"), rules)
    hit = F.exists(domains(F.col("host")), cascade.holds)
    return split.withColumns({"rule": rule, "listed": hit}).withColumn(
        "verdict", F.coalesce(say, F.when(F.col("listed"), "block").otherwise("allow"))
    )
