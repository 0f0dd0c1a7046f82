"""URL filters by a Bloom filter cascade: exact membership without joins.

Level 1 encodes the listed keys; level 2 the corpus's unlisted keys that level 1 lets
through; level 3 the listed keys that level 2 lets through; and so on until a level lets
none through. Over the complete key universe of the corpus the levels, read alternately,
are exact. Each level is built by a distributed ``bit_or`` of bit positions and carried in
the plan as one array literal, so judging a page is a projection: no join, no shuffle, no
Python. Level 1 takes more bits a listed key the more unlisted keys there are, so that it
lets through no more of them than keys are listed: the size follows the list, and the
corpus only by its logarithm. Lists that need more than ``MAX_FILTER_BITS`` are split by the
hash of the key into parts with a cascade each, and the pages pass one part after the other,
written in between, so that no plan ever holds more than one part's literals.

Keys of a page are strings of a tag and a value: ``allow|`` or ``block|`` with a host
suffix and a path prefix of a shape that occurs in the rules, and ``host|`` with a host
suffix, for the listed hosts. Of the rules that fit, the longest wins; without one, a page
is blocked if its host or a parent domain is listed, else allowed.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and is allowed; a host may be empty or hold any characters; repeated pages are judged
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import groups_for, prepare, stored

# (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
# A domain is listed if a label of its host has one of these as a hyphen-separated part.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "malware", "phish", "pills", "porn", "spam", "warez", "xxx")
BITS_PER_KEY = 10
MAX_FILTER_BITS = 1 << 25

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Cascade:
    """Bit arrays by level, as 64-bit words."""

    levels: list[tuple[int, int, list[int]]] = field(default_factory=list)   # (bits, hashes, words)

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe the cascade was built over."""
        found = F.lit(False)
        for i in range(len(self.levels) - 1, -1, -1):
            found = _lets_through(self.levels[i], i, key) & ~found
        return found


def _position(key: Column, level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level * 100 + i)), F.lit(bits).cast("long"))


def _lets_through(level: tuple[int, int, list[int]], number: int, key: Column) -> Column:
    bits, hashes, words = level
    # one folded literal, instead of one expression per word
    held = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    out = F.lit(True)
    for i in range(hashes):
        at = _position(key, number, i, bits)
        out = out & (F.getbit(F.get(held, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return out


def bits_per_key(n_in: int, n_out: int) -> int:
    """Bits for each of ``n_in`` encoded keys, so that at most about ``n_in`` of ``n_out``
    other keys are let through."""
    return max(BITS_PER_KEY, math.ceil(1.5 * math.log2(max(n_out, 1) / max(n_in, 1))) if n_out > n_in else 0)


def _level(keys: DataFrame, n: int, per_key: int, number: int) -> tuple[int, int, list[int]]:
    bits, hashes = max(64, -(-n * per_key // 64) * 64), round(0.6 * per_key)
    at = F.explode(F.array(*[_position(F.col("key"), number, i, bits) for i in range(hashes)]))
    words = keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")) \
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits"))
    found = {r["word"]: r["bits"] for r in words.collect()}              # at most bits / 64 rows
    return bits, hashes, [found.get(w, 0) for w in range(bits // 64)]


def build_cascade(universe: DataFrame, listed: DataFrame) -> Cascade:
    """``universe`` and ``listed`` have a column ``key``; repeats and nulls are no matter."""
    return _cascade(_keys(universe, listed))


def _cascade(keys: DataFrame) -> Cascade:
    """``keys`` has distinct ``key`` and ``listed`` (1 or 0): the universe."""
    cascade = Cascade()
    rest = [keys.filter("listed = 1").select("key"), keys.filter("listed = 0").select("key")]
    left = [rest[0].count(), rest[1].count()]
    while True:
        number = len(cascade.levels)
        side = number % 2
        if number:
            rest[side] = rest[side].filter(_lets_through(cascade.levels[-1], number - 1, F.col("key")))
            left[side] = rest[side].count()
        if left[side] == 0:
            return cascade
        per_key = bits_per_key(left[side], left[1 - side])
        cascade.levels.append(_level(rest[side], left[side], per_key, number))


def _keys(universe: DataFrame, listed: DataFrame) -> DataFrame:
    both = universe.select("key", F.lit(0).alias("listed")).unionByName(listed.select("key", F.lit(1).alias("listed")))
    return stored(both.filter("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed")), "url-keys")


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``host``: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; ``path``: from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return pages.withColumn("host", F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)) \
        .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def _rule_keys(rules) -> Column:
    """The rules a page could fit, as structs that sort by length: one for each shape
    (labels in the host, characters in the path, verdict) that occurs in ``rules``."""
    shapes = sorted({(host.count(".") + 1, len(path), verdict) for verdict, host, path in rules})
    out = []
    for labels, chars, verdict in shapes:
        rule = F.concat(F.substring_index("host", ".", -labels), F.substring(F.col("path"), 1, chars))
        out.append(F.struct(F.length(rule).alias("n"), rule.alias("rule"), F.lit(verdict).alias("verdict"),
                            F.concat(F.lit(f"{verdict}|"), rule).alias("key")))
    if not out:
        return F.expr("cast(array() AS array<struct<n:int,rule:string,verdict:string,key:string>>)")
    return F.array(*out)


def _host_keys(depth: int) -> Column:
    """``host|`` and the last 1 .. ``depth`` labels of the host (all, if it has fewer)."""
    if not depth:
        return F.expr("cast(array() AS array<string>)")
    labels = f"least({depth}, size(split(host, '[.]')))"
    return F.expr(f"transform(sequence(1, {labels}), k -> concat('host|', substring_index(host, '.', -k)))")


def judge(pages: DataFrame, rules=RULES, listed_hosts: DataFrame | None = None, url: str = "url",
          max_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` added. ``listed_hosts(host)``: domains
    that are blocked, with their subdomains, where no rule fits."""
    spark = prepare(pages.sparkSession)
    listed = spark.createDataFrame([(f"{v}|{h}{p}",) for v, h, p in rules], "key string")
    depth = 0
    if listed_hosts is not None:
        hosts = stored(listed_hosts.select("host").filter("host <> ''").distinct(), "url-listed")
        depth = hosts.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0
        listed = listed.unionByName(hosts.select(F.concat(F.lit("host|"), "host").alias("key")))
    judged = with_host_and_path(pages.drop("host", "path", "rule", "verdict"), url)
    fits = _rule_keys(rules)
    candidates = F.concat(F.transform(fits, lambda c: c["key"]), _host_keys(depth))
    keys = _keys(judged.select("host", "path").distinct().select(F.explode(candidates).alias("key")).distinct(), listed)
    n = keys.agg(F.coalesce(F.sum("listed"), F.lit(0)).alias("n_in"), F.count("*").alias("n")).first()
    # level 1 fills half of the limit, which leaves room for the later levels and uneven parts
    parts = groups_for(n["n_in"] * bits_per_key(n["n_in"], n["n"] - n["n_in"]), max_bits / 2)
    judged = judged.withColumn("_found", F.expr("cast(array() AS array<string>)"))
    for part in range(parts):
        cascade = _cascade(keys.filter(_in_part(F.col("key"), part, parts)))
        found = F.filter(candidates, lambda k: _in_part(k, part, parts) & cascade.contains(k))  # noqa: B023
        judged = judged.withColumn("_found", F.concat("_found", found))
        if part < parts - 1:
            judged = stored(judged, "url-part")
    best = F.array_max(F.filter(fits, lambda c: F.array_contains("_found", c["key"])))
    blocked = F.exists("_found", lambda k: k.startswith("host|"))
    return judged.withColumn("_best", best) \
        .withColumn("rule", F.col("_best.rule")) \
        .withColumn("verdict", F.coalesce("_best.verdict", F.when(blocked, "block").otherwise("allow"))) \
        .drop("_best", "_found")


def _in_part(key: Column, part: int, parts: int) -> Column:
    if parts == 1:
        return F.lit(True)
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(parts)) == part


def listed_domains(pages: DataFrame, words=LISTED_WORDS, url: str = "url") -> DataFrame:
    """Domains of ``pages`` with a listed word: from the first label that has one to the
    end of the host."""
    found = F.regexp_extract("host", rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(words)})(?:-[^.]*)?\..*)$", 1)
    return with_host_and_path(pages.select(url), url).select(found.alias("host")).filter("host <> ''").distinct()


def judge_pages(pages: DataFrame) -> DataFrame:
    return judge(pages.select("page_id", "url"), listed_hosts=listed_domains(pages)) \
        .select("page_id", "host", "path", "rule", "verdict")


def judge_sql(rules=RULES, words=LISTED_WORDS) -> str:
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n
  FROM cut),
rules(verdict, rhost, rpath) AS (VALUES {listed}),
fit AS (
  SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY n)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host, '(^|\.)([^.]*-)?({'|'.join(words)})(-[^.]*)?\.')
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fit USING (n)"""
