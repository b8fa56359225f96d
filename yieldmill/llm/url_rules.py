"""URL filters: prefix rules on hosts and paths, judged in one sorted sweep.

Hosts are written in canonical order, the labels reversed and each closed by a dot:
``www.example.net`` becomes ``net.example.www.``.  So a rule's host covers one
interval of keys, itself and all its subdomains, and intervals are nested or apart.

* Cut points from a sample split the sorted urls into parts of about equal size.  A
  cut is a key, a path and a row marker, so one host, or one url that a third of all
  rows hold, still spreads over parts.  The sample has about 24 urls a part.
* A rule goes to every part its host's interval meets; where a part lies inside one
  host, only if its path can occur there too.
* Each part is sorted, rules before the urls of their host, and swept once.  A stack
  holds the hosts whose intervals are open; a host has its path rules, nested by a
  stack in the same way.  A task holds the rules of its open hosts and one Arrow batch.

A rule fits when its host is the url's or a parent domain of it and the url's path
starts with the rule's; the longest rule (host and path together) wins, of two equally
long ones that with the longer host.  Without a rule the verdict is ``default``.

Defined results: a null url or one without ``://`` has empty host and path; hosts
compare without A-Z case, paths exactly; ports and user names are part of the host.  A
rule with an empty or null host fits every host; a null path is empty.  A rule given
twice counts once; of equal rules with different verdicts ``block`` wins; a rule whose
verdict is null is dropped, any other verdict than allow or block ends the job.  Rows
are kept whole, repeated ones too; an empty table gives an empty one.  The columns
host, path, rule and verdict replace columns of these names; other columns stay, and
travel with the url, so select what is needed before.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLED = 24  # urls looked at for each part
CUT_CHARS = 256  # longest piece of a key or path in a cut
LEAST = -(1 << 63)
RESULTS = ("host", "path", "rule", "verdict")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Cut = tuple[str, str, int]


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?`` or ``#``; empty without one."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(F.regexp_replace(_rest(url), "^[^/?#]+", ""), "^[^?#]*", 0)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_key(host: Column) -> Column:
    """Reversed labels, each closed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``rules`` has host, path and verdict."""
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    link = F.col(url).cast("string")
    kept = [F.col(f"`{name}`") for name in pages.columns if name not in RESULTS]
    urls = pages.select(
        F.struct(*kept).alias("row"), host_of(link).alias("host"), path_of(link).alias("path")
    ).withColumns({"key": host_key(F.col("host")), "mark": F.xxhash64(F.monotonically_increasing_id())})
    cuts = cut_points(urls, parts)
    row_type = urls.schema["row"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("key", T.StringType()),
            T.StructField("is_url", T.BooleanType()),
            T.StructField("path", T.StringType()),
            T.StructField("host", T.StringType()),
            T.StructField("block", T.BooleanType()),
            T.StructField("row", row_type),
        ]
    )

    def deal_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = (batch.column(name).to_pylist() for name in ("key", "path", "mark"))
            part = [bisect_right(cuts, cell) for cell in zip(*cells)]
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    batch.column("key"),
                    pa.array([True] * n, pa.bool_()),
                    batch.column("path"),
                    batch.column("host"),
                    pa.nulls(n, pa.bool_()),
                    batch.column("row"),
                ],
                names=schema.names,
            )

    dealt = urls.mapInArrow(deal_urls, schema)
    both = dealt.unionByName(_dealt_rules(clean_rules(rules), cuts), allowMissingColumns=True)
    swept = both.repartitionById(len(cuts) + 1, F.col("part")).sortWithinPartitions("key", "is_url", "path")
    result = T.StructType(
        [T.StructField("row", row_type), *[T.StructField(name, T.StringType()) for name in RESULTS]]
    )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts: list[OpenHost] = []
        for batch in batches:
            names = ("key", "is_url", "path", "host", "block")
            keys, is_url, paths, names_, blocks = (batch.column(name).to_pylist() for name in names)
            rule, verdict = [], []
            for k, key in enumerate(keys):
                while hosts and not key.startswith(hosts[-1].key):
                    hosts.pop()
                if is_url[k]:
                    found = longest(hosts, paths[k])
                    rule.append(found and found[0])
                    verdict.append(default if found is None else "block" if found[1] else "allow")
                else:
                    if not hosts or hosts[-1].key != key:
                        hosts.append(OpenHost(key))
                    hosts[-1].add(paths[k], names_[k], blocks[k])
            if rule:
                urls_ = batch.filter(batch.column("is_url"))
                yield pa.RecordBatch.from_arrays(
                    [
                        urls_.column("row"),
                        urls_.column("host"),
                        urls_.column("path"),
                        pa.array(rule, pa.string()),
                        pa.array(verdict, pa.string()),
                    ],
                    names=result.names,
                )

    return swept.mapInArrow(sweep, result).select("row.*", *RESULTS)


class OpenHost:
    """A host whose interval the sweep is in, and its path rules in ascending order."""

    def __init__(self, key: str):
        self.key = key
        self.paths: list[str] = []
        self.above: list[int] = []  # the nearest shorter path that a path starts with, or -1
        self.rules: list[tuple[str, bool]] = []

    def add(self, path: str, host: str, block: bool) -> None:
        at = len(self.paths) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.above[at]
        self.paths.append(path)
        self.above.append(at)
        self.rules.append((host + path, block))

    def fitting(self, path: str) -> tuple[str, bool] | None:
        # Every rule between a prefix of the path and the path starts with that prefix.
        at = bisect_right(self.paths, path) - 1
        while at >= 0 and not path.startswith(self.paths[at]):
            at = self.above[at]
        return self.rules[at] if at >= 0 else None


def longest(hosts: list[OpenHost], path: str) -> tuple[str, bool] | None:
    """The longest fitting rule; hosts come from the broadest to the narrowest."""
    best = None
    for host in hosts:
        found = host.fitting(path)
        if found is not None and (best is None or len(found[0]) >= len(best[0])):
            best = found
    return best


def clean_rules(rules: DataFrame) -> DataFrame:
    """One row for each host and path, with ``block`` where any of them says so."""
    verdict = F.col("verdict")
    wrong = F.raise_error(F.concat(F.lit("a rule's verdict is allow or block, not "), verdict))
    block = F.when(verdict.isin("allow", "block"), verdict == "block").otherwise(wrong.cast("boolean"))
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    named = rules.filter(verdict.isNotNull()).select(
        host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), block.alias("block")
    )
    key = F.when(F.col("host") == "", "").otherwise(host_key(F.col("host")))
    return named.groupBy("host", "path").agg(F.bool_or("block").alias("block")).withColumn("key", key)


def cut_points(urls: DataFrame, parts: int) -> list[Cut]:
    """At most ``parts`` - 1 cuts that split the sorted urls about evenly."""
    rows, wanted = urls.count(), SAMPLED * parts
    if parts < 2 or not rows:
        return []
    share = min(1.0, wanted / rows)
    piece = lambda name: F.substring(name, 1, CUT_CHARS)
    sample = urls.select(piece("key"), piece("path"), "mark").sample(share, seed=11)
    # About 24 short rows a part, whatever the number of urls.
    drawn = sorted(tuple(row) for row in sample.collect())
    return [drawn[len(drawn) * k // parts] for k in range(1, parts)] if drawn else []


def _dealt_rules(rules: DataFrame, cuts: list[Cut]) -> DataFrame:
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, paths = (batch.column(name).to_pylist() for name in ("key", "path"))
            for k in range(batch.num_rows):
                parts = list(parts_of(keys[k], paths[k], cuts))
                for low in range(0, len(parts), 4096):
                    some = parts[low : low + 4096]
                    one = pa.array([k] * len(some), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some, pa.int32()),
                            batch.column("key").take(one),
                            pa.array([False] * len(some), pa.bool_()),
                            *[batch.column(name).take(one) for name in ("path", "host", "block")],
                        ],
                        names=["part", "key", "is_url", "path", "host", "block"],
                    )

    schema = "part int, key string, is_url boolean, path string, host string, block boolean"
    return rules.mapInArrow(deal, schema)


def parts_of(key: str, path: str, cuts: list[Cut]) -> Iterator[int]:
    """The parts in which a url below this host, with a path that starts so, can lie."""
    first = bisect_right(cuts, (key, "", LEAST))
    # All keys with this prefix come before the prefix with its last dot made a slash.
    last = bisect_left(cuts, (key[:-1] + "/", "", LEAST)) if key else len(cuts)
    for part in range(first, last + 1):
        if 0 < part < len(cuts) and cuts[part - 1][0] == cuts[part][0] and len(cuts[part][0]) < CUT_CHARS:
            low, high = cuts[part - 1][1], cuts[part][1]
            if path > high or path < low and not low.startswith(path):
                continue
        yield part
