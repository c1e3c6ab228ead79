"""URL allow and block rules by a sort-merge range join.

A host is keyed by the tuple of its labels, reversed; a rule's host and all its
subdomains are then one interval of keys, whatever bytes a label holds. The paths
that begin with a rule's path are an interval of paths of its host likewise.

Few rules (``RULE_BLOCK`` of them and ``RULE_CHARS`` characters at most, counted)
travel with the tasks: each Arrow batch of pages is sorted by key and merged with
the sorted rules; a stack holds the rule hosts whose intervals are open, innermost
last. Of a host's paths the last one not after the page's is found by binary search, and
the paths it lies in lead to the longest that fits. Pages are not shuffled.

More rules stay in a table, and pages and rules meet by ranges. A page asks once for
each of its host's endings, as far as rules have that many labels; equal questions
are asked once, so a hot url or a hot path of many subdomains is one row. A bounded
sample of questions and rules cuts the order of (host, path) into ranges; a rule
goes to every range that its interval meets, which are for each bound only the
rules that the bound lies in. There a sweep in order keeps a stack of the open
nested rules: its top answers the question. Answers are joined back to urls.

Nulls, urls without ``://`` and empty urls have an empty host and path, which no
rule fits. Of the fitting rules the longest (host plus path) wins, then the one
with the longer host, then block before allow, then the spelling of the host.
A rule of a null path fits all paths; one without a host or verdict is an error.
Very long urls are judged whole. Rows that repeat, in page_id or altogether, are
judged each for itself; an empty table gives an empty result, no rules the default.
Only page_id and url are read, so other columns, whatever their names, change
nothing and are not passed on.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.llm.common import dropped, released, table, written

RULE_BLOCK = 65_536
RULE_CHARS = 8 << 20
#: Sampled keys for each range, and characters of a key that make a bound.
SAMPLED, BOUND = 64, 256
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


Key = tuple[str, ...]


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule("block", "com", "/en/"),
    Rule("allow", "example.com", "/en/7"),
    Rule("allow", "net", "/de/"),
    Rule("block", "example.net", "/de/8"),
    Rule("block", "org", "/es/"),
)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) of a url; both empty for null or a url without ``://``."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min((i for i in (rest.find("/"), rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    tail = rest[cut:]
    end = min((i for i in (tail.find("?"), tail.find("#")) if i >= 0), default=len(tail))
    return rest[:cut].translate(_LOWER), tail[:end]


def host_key(host: str) -> Key:
    """Reversed labels: the keys of a host's subdomains begin with the host's key."""
    return tuple(reversed(host.split("."))) if host else ()


def under(key: Key, of: Key) -> bool:
    """Whether a key is that of a host or of one of its subdomains."""
    return key[: len(of)] == of


class Paths:
    """The rules of one host: paths in order, each with the place of the longest other path that it begins with."""

    def __init__(self, rules: Iterable[Rule]) -> None:
        first: dict[str, Rule] = {}
        for r in sorted(set(rules), key=lambda r: (r.path, r.verdict != "block", r.verdict, r.host)):
            first.setdefault(r.path, r)
        self.rules = list(first.values())
        self.paths = list(first)
        self.outer: list[int] = []
        for i, path in enumerate(self.paths):
            self.outer.append(self._among(path, i - 1))

    def _among(self, path: str, at: int) -> int:
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.outer[at]
        return at

    def longest(self, path: str) -> Rule | None:
        at = self._among(path, bisect_right(self.paths, path) - 1)
        return self.rules[at] if at >= 0 else None


def rule_hosts(rules: Iterable[Rule]) -> list[tuple[Key, Paths]]:
    """(key, rules of that host) in key order."""
    by: dict[Key, list[Rule]] = {}
    for r in rules:
        by.setdefault(host_key(r.host.translate(_LOWER)), []).append(r)
    return [(k, Paths(v)) for k, v in sorted(by.items())]


def sweep(keys: list[tuple[Key, str]], hosts: list[tuple[Key, Paths]]) -> list[Rule | None]:
    """The winning rule of each (host key, path)."""
    won: list[Rule | None] = [None] * len(keys)
    stack: list[tuple[Key, Paths]] = []
    at = 0
    for i in sorted(range(len(keys)), key=lambda i: keys[i][0]):
        key, path = keys[i]
        while at < len(hosts) and hosts[at][0] <= key:
            while stack and not under(hosts[at][0], stack[-1][0]):
                stack.pop()
            stack.append(hosts[at])
            at += 1
        while stack and not under(key, stack[-1][0]):
            stack.pop()
        fits = [r for _, rules in stack if (r := rules.longest(path))]
        won[i] = max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host)), default=None)
    return won


_PARTS = "page_id long, host string, path string"


def _parted(batch: pa.RecordBatch) -> tuple[list[tuple[str, str]], list[pa.Array]]:
    """The (host, path) of a batch's urls, and the columns page_id, host, path."""
    parts = [split_url(u) for u in batch.column(1).to_pylist()]
    return parts, [batch.column(0).cast(pa.int64()), pa.array([h for h, _ in parts], pa.string()), pa.array([p for _, p in parts], pa.string())]


def judge(pages: DataFrame, rules: Iterable[Rule] | DataFrame = RULES, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page (page_id, url); rules are a list or a table (verdict, host, path)."""
    if isinstance(rules, DataFrame):
        given = rules.select(F.col("verdict").cast("string").alias("verdict"), F.col("host").cast("string").alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"))
        n, chars, bad = given.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("host") + F.length("path")), F.lit(0)), F.count_if(F.col("verdict").isNull() | (F.coalesce("host", F.lit("")) == ""))).first()
    else:
        given = [Rule(r.verdict, r.host, r.path or "") for r in rules]
        n, chars, bad = len(given), sum(len(r.host or "") + len(r.path) for r in given), sum(not r.host or not r.verdict for r in given)
    if bad:
        raise ValueError("a rule needs a host and a verdict")
    if n > RULE_BLOCK or chars > RULE_CHARS:
        return _by_ranges(pages, given if isinstance(given, DataFrame) else pages.sparkSession.createDataFrame(given, "verdict string, host string, path string"), default)
    hosts = rule_hosts([Rule(*r) for r in given.collect()] if isinstance(given, DataFrame) else given)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, columns = _parted(batch)
            won = sweep([(host_key(h), p) for h, p in parts], hosts)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([r and r.host + r.path for r in won], pa.string()), pa.array([r.verdict if r else default for r in won], pa.string())],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return pages.select("page_id", "url").mapInArrow(run, _PARTS + ", rule string, verdict string")


def _by_ranges(pages: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """``judge`` with rules that don't fit a task."""

    @released
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(_parted(batch)[1], ["page_id", "host", "path"])

    parted = written(pages.select("page_id", "url").mapInArrow(split, _PARTS), "pages")
    ending = F.translate("host", _UPPER, _UPPER.lower())
    first = F.min(F.struct((F.col("verdict") != "block").alias("soft"), "verdict", "host")).alias("first")
    held = written(rules.groupBy(ending.alias("ending"), "path").agg(first).select("ending", "path", "first.verdict", "first.host"), "rules")
    deepest, longest = held.agg(F.max(F.size(F.split("ending", "[.]"))), F.max(F.length("ending"))).first()

    labels = F.col("labels")
    endings = F.filter(F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))), lambda k: F.array_join(F.slice(labels, -k, k), ".")), lambda e: F.length(e) <= longest)
    urls = parted.where("host <> ''").select("host", "path").distinct().select("host", "path", F.split("host", "[.]").alias("labels")).select("host", "path", F.explode(endings).alias("ending"))
    asked = written(urls.select("ending", "path").distinct(), "asked")
    answers = written(_answers(asked, held), "answers")
    rank = F.struct((F.length("shown") + F.length("fit")).alias("size"), F.length("shown").alias("of_host"), F.concat("shown", "fit").alias("rule"), "verdict")
    best = written(urls.join(answers, ["ending", "path"]).groupBy("host", "path").agg(F.max(rank).alias("best")).select("host", "path", "best.rule", "best.verdict"), "verdicts")
    for scratch in (held, asked, answers):
        dropped(scratch)
    return parted.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _answers(asked: DataFrame, rules: DataFrame) -> DataFrame:
    """(ending, path, verdict, shown, fit): for each question (ending, path) the rule of that host with the longest fitting path, if any."""
    ranges = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = asked.select("ending", "path").union(rules.select("ending", "path"))
    drawn = keys.orderBy(F.xxhash64("ending", "path")).limit(SAMPLED * ranges).select(F.substring("ending", 1, BOUND), F.substring("path", 1, BOUND))
    order = sorted({tuple(r) for r in drawn.collect()})  # a bounded number of bounded keys
    bounds = sorted({order[len(order) * k // ranges] for k in range(1, ranges)}) if order else []

    @released
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, place = [], []
            for i, (ending, path, verdict) in enumerate(zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)):
                at = bisect_right(bounds, (ending, path))
                row.append(i)
                place.append(at)
                while verdict is not None and at < len(bounds) and bounds[at][0] == ending and bounds[at][1].startswith(path):
                    at += 1
                    row.append(i)
                    place.append(at)
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row, pa.int64())).columns, pa.array(place, pa.int32())], [*batch.schema.names, "place"])

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stack = None, []  # the open rules of a host: (path, verdict, host as spelt)
        for batch in batches:
            out = []
            for ending, path, verdict, host, place in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (place, ending) != here:
                    here, stack = (place, ending), []
                while stack and not path.startswith(stack[-1][0]):
                    stack.pop()
                if verdict is not None:
                    stack.append((path, verdict, host))
                elif stack:
                    fit, said, shown = stack[-1]
                    out.append((ending, path, said, shown, fit))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.string()) for k in range(5)], ["ending", "path", "verdict", "shown", "fit"])

    none = F.lit(None).cast("string")
    both = asked.select("ending", "path", none.alias("verdict"), none.alias("host")).union(rules.select("ending", "path", "verdict", "host"))
    dealt = both.mapInArrow(deal, "ending string, path string, verdict string, host string, place int").repartition(ranges, "place")
    # A rule comes before the questions of its own path.
    ordered = dealt.sortWithinPartitions("place", "ending", "path", F.col("verdict").isNull())
    return ordered.mapInArrow(run, "ending string, path string, verdict string, shown string, fit string")


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH rules(verdict, rhost, rpath) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'),
  ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')
), parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM parts
), fits AS (
  SELECT page_id, host, path, r.verdict, rhost || rpath AS rule, row_number() OVER (PARTITION BY page_id, host, path
    ORDER BY length(rhost) + length(rpath) DESC NULLS LAST, length(rhost) DESC) AS place, count(*) OVER (PARTITION BY page_id) AS n
  FROM split LEFT JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

QUERIES = {"op2_url_rules": op2_url_rules}
ORACLES = {"op2_url_rules": ORACLE}
