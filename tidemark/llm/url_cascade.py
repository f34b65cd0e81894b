"""URL filter with a Bloom filter cascade: exact membership of rule keys without a join. DataFrame and SQL only.

A rule is a key ``host/path`` with an action. It fits its host and all subdomains if the url's path
starts with its path (which begins and ends with a slash); the longest fitting rule decides. So a url is
judged by its few *candidate keys*: the suffixes of its host, in as many labels as some rule has, joined
to the prefixes of its path, of as many slashes as some rule has.

For each action one cascade is built over the corpus's whole key universe (every candidate key of every
url). Level 1 encodes the listed keys; the universe's keys that pass it though they are not listed are its
false positives, and level 2 encodes those; the listed keys that pass level 2 by mistake go to level 3;
and so on until a level has no false positives. A key of the universe is listed if and only if the first
level it fails is even, or it passes all of an odd number of levels. Level 1 takes the rate
``r / (sqrt(2) s)`` for ``r`` listed keys among ``s``, later ones 1/2, so every level holds in the order of
``r log(s / r)`` bits: the list bounds the size of what tasks are sent, not the corpus.

Rows. A null url, or one without ``://``, has an empty host and path and no candidate: rule null, verdict
``allow`` (the method's). Repeated rows come back as often; a null page_id stays. Extra columns are
ignored. Empty tables and empty rule lists give cascades without levels, which list nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free, stored

#: (key, action): the production rules.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DEFAULT = "allow"
MAX_LEVELS = 60
_A, _Z = ord("A"), ord("Z")
_UPPER = "".join(map(chr, range(_A, _Z + 1)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def candidate_keys(host: Column, path: Column, keys: list[str]) -> Column:
    """The keys that could fit a url: only host and path depths that some rule has."""
    labels = sorted({k.split("/", 1)[0].count(".") + 1 for k in keys})
    slashes = sorted({k.split("/", 1)[1].count("/") + 1 for k in keys})
    out = []
    for n in labels:
        # substring_index takes the last n labels; a shorter host gives itself, which n must not repeat.
        long_enough = F.length(host) - F.length(F.translate(host, ".", "")) >= n - 1
        suffix = F.substring_index(host, ".", -n)
        for m in slashes:
            prefix = F.regexp_extract(path, r"^((?:/[^/]*){%d}/)" % (m - 1), 1)
            out.append(F.when(long_enough & (host != "") & (prefix != ""), F.concat(suffix, prefix)))
    return F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``hashes`` positions of ``bits``, held as longs of 64 bits."""

    seed: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def position(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(self.seed * 1000 + i)), F.lit(self.bits)).cast("int")

    def passes(self, key: Column) -> Column:
        words = F.lit(list(self.words) or [0]).cast("array<bigint>")
        out = F.lit(True)
        for i in range(self.hashes):
            at = self.position(key, i)
            out = out & (F.getbit(F.element_at(words, (F.shiftright(at, 6) + 1).cast("int")), at.bitwiseAND(63)) == 1)
        return out


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...] = field(default=())

    def contains(self, key: Column) -> Column:
        """Exact for keys of the universe: the parity of the first level that the key fails."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for n, level in reversed(list(enumerate(self.levels))):
            listed = F.when(level.passes(key), listed).otherwise(F.lit(n % 2 == 1))
        return listed


def _level(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """Encode the keys. Only set bits reach the driver, and their number is bounded by the level's size."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(64, 64 * math.ceil(count * hashes / math.log(2) / 64))
    shape = Level(seed, bits, hashes, ())
    places = keys.select(F.explode(F.array(*[shape.position(F.col("key"), i) for i in range(hashes)])).alias("p"))
    words = [0] * (bits // 64)
    found = places.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, p & 63)")).alias("m"))
    for row in found.collect():
        words[row.w] = row.m
    return Level(seed, bits, hashes, tuple(words))


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the ``listed`` keys over the distinct keys of ``universe`` (both one column ``key``)."""
    listed = stored(listed.join(universe, "key", "left_semi").distinct(), "cascade-listed")
    r, s = listed.count(), universe.count()
    if not r:
        return Cascade()
    levels, inside, outside, rate = [], listed, None, min(0.5, r / (math.sqrt(2) * max(s, 1)))
    count = r
    while True:
        levels.append(_level(inside, count, rate, len(levels) + 1))
        if len(levels) > MAX_LEVELS:
            raise RuntimeError("the cascade does not end")
        if outside is None:
            # The universe without the listed keys: a left-anti join on a side the list bounds.
            outside = universe.join(listed, "key", "left_anti")
        wrong = stored(outside.where(levels[-1].passes(F.col("key"))), f"cascade-{len(levels)}")
        count = wrong.count()
        if not count:
            return Cascade(tuple(levels))
        inside, outside, rate = wrong, inside, 0.5


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, default: str = DEFAULT) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page's url."""
    for key, action in rules:
        host, _, path = key.partition("/")
        if not host or not (path == "" or path.endswith("/")) or action not in ("allow", "block"):
            raise ValueError(f"not a rule: {key!r} {action!r}")
    if len({k for k, _ in rules}) != len(rules):
        raise ValueError("a key is listed twice")
    spark = pages.sparkSession
    keys = [k for k, _ in rules]
    parsed = clash_free(pages, "page_id", "url").select("page_id", host_of(F.col("url")).alias("host"),
                                                        path_of(F.col("url")).alias("path"))
    parsed = parsed.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), keys))
    universe = stored(parsed.select(F.explode("keys").alias("key")).distinct(), "cascade-universe")
    cascades = {}
    for action in ("allow", "block"):
        own = [(k,) for k, a in rules if a == action]
        cascades[action] = build(spark.createDataFrame(own, "key string"), universe) if own else Cascade()

    def fit(k: Column) -> Column:
        return cascades["allow"].contains(k) | cascades["block"].contains(k)

    # Of the candidates that are rules the longest wins; two of one length cannot both be of one url's
    # host and path and differ in host alone, so the longer host decides a tie.
    best = F.reduce(
        F.filter("keys", fit), F.lit(None).cast("string"),
        lambda top, k: F.when(top.isNull() | (F.length(k) > F.length(top)) | (
            (F.length(k) == F.length(top)) & (F.locate("/", k) > F.locate("/", top))), k).otherwise(top))
    ruled = parsed.withColumn("rule", best)
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(
        cascades["block"].contains(F.col("rule")), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def oracle(rules: tuple[tuple[str, str], ...] = RULES, default: str = DEFAULT) -> str:
    """The same judgement by a join with the rules."""
    values = ", ".join(f"('{k.partition('/')[0]}', '/{k.partition('/')[2]}', '{k}', '{a}')" for k, a in rules)
    return f"""
with p as (
  select page_id, case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end as u from pages),
q as (
  select page_id, translate(regexp_extract(u, '^([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') as host,
    regexp_extract(u, '^[^/?#]*([^?#]*)', 1) as path, row_number() over () as r from p),
rules(h, pre, key, act) as (values {values}),
m as (
  select r, arg_max(key, length(key)) as rule, arg_max(act, length(key)) as act
  from q join rules on (q.host = h or ends_with(q.host, '.' || h)) and starts_with(q.path, pre) group by r)
select page_id, host, path, m.rule as rule, coalesce(m.act, '{default}') as verdict from q left join m on q.r = m.r"""
