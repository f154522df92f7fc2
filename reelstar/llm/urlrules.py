"""URL filters as a sort-merge range join.

A host is turned round, label by label (``www.example.com`` -> ``com.example.www.``), so that a
host and all its subdomains are one interval of the sorted hosts. A rule has a path besides, and
must hold on subdomains too; so a URL is looked at once for each ending of its host that some
rule names, under the key *reversed ending + path*. There every rule is the interval of the keys
that begin with its own, and intervals either nest or are apart.

Rules and URLs are sorted together by key and swept: a rule is put on the stack when its interval
begins and taken off when it is over, so the top of the stack is the longest rule of a URL. The
sort is cut into ranges, however hot a host is. What is open where a range begins are the
rules whose key begins the range's first key: an equi-join of the prefixes of one key a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import packed, unpacked
from reelstar.operators.joins import lookup_join
from reelstar.session import stored

_FOUND = "url string, length int, host_length int, rule string, verdict string"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.coalesce(_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("."))


def _intervals(rules: DataFrame, host: str, path: str, verdict: str) -> DataFrame:
    """One row for each host and path, with the beginning of its interval in ``k``."""
    named = rules.select(
        _lower(F.col(host)).alias("host"), F.col(path).alias("path"), F.col(verdict).alias("verdict")
    )
    # 'block' is after 'allow', so a rule given both ways blocks
    one = named.filter("host <> ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    labels = _labels(F.col("host"))
    return one.filter("path IS NOT NULL AND verdict IS NOT NULL").select(
        F.concat(_key(labels), "path").alias("k"),
        _key(labels).alias("ending"),
        F.size(labels).alias("labels"),
        F.length("host").alias("host_length"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, k, url, host_length, rule, verdict) in order, rules before URLs of one key."""
    stack: list[tuple] = []
    part = None
    for batch in batches:
        found: list[tuple] = []
        for at, k, url, host_length, rule, verdict in zip(*(c.to_pylist() for c in batch.columns)):
            if at != part:
                part, stack = at, []
            while stack and not k.startswith(stack[-1][0]):
                stack.pop()
            if url is None:
                stack.append((k, len(rule), host_length, rule, verdict))
            elif stack:
                found.append((url, *stack[-1][1:]))
        if found:
            url, length, host_length, rule, verdict = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(url, pa.string()), pa.array(length, pa.int32()),
                 pa.array(host_length, pa.int32()), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())],
                ["url", "length", "host_length", "rule", "verdict"],
            )


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url`` (host and path in one), ``rule`` and ``verdict`` of the URLs that a rule fits.

    ``urls`` holds different ``host`` and ``path``; ``rules`` are intervals.
    """
    spark = urls.sparkSession
    rules = stored(spark, rules, "url-rules")
    bounds = rules.agg(F.max("labels"), F.collect_set(F.length("k"))).first()
    if bounds[0] is None:
        return spark.createDataFrame([], "url string, rule string, verdict string")
    deepest, lengths = bounds[0], sorted(bounds[1])  # no more lengths than the longest rule has
    labels = _labels(F.col("host"))
    ends = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))),
        lambda n: _key(F.slice(labels, F.lit(1), n)),
    )
    asked = urls.select(
        F.concat("host", "path").alias("url"), "path", F.explode(ends).alias("ending")
    ).join(rules.select("ending").distinct(), "ending", "left_semi")
    columns = ["k", "url", "host_length", "rule", "verdict"]
    intervals = rules.withColumn("url", F.lit(None).cast("string")).select(*columns)
    none = F.lit(None)
    points = asked.select(
        F.concat("ending", "path").alias("k"), "url", none.cast("int").alias("host_length"),
        none.cast("string").alias("rule"), none.cast("string").alias("verdict"),
    )
    order = ["k", F.col("url").isNotNull(), "url"]
    ranges = intervals.unionByName(points).repartitionByRange(*order)
    ranges = stored(spark, ranges.withColumn("part", F.spark_partition_id()), "url-ranges")
    edges = ranges.groupBy("part").agg(F.min("k").alias("first"))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("first"))
    begun = edges.select("part", "first", F.explode(fits).alias("n")).select(
        "part", F.substring("first", F.lit(1), F.col("n")).alias("k")
    )
    # a rule that begins in the range itself may come twice, which changes nothing
    opened = begun.join(intervals, "k").select("part", *columns)
    parts = (edges.agg(F.max("part")).first()[0] or 0) + 1
    both = ranges.select("part", *columns).unionByName(opened).repartitionById(parts, F.col("part"))
    found = both.sortWithinPartitions("part", *order).mapInArrow(_sweep, _FOUND)
    best = F.max_by(F.struct("rule", "verdict"), F.struct("length", "host_length"))
    return found.groupBy("url").agg(best.alias("best")).select("url", "best.*")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    host: str = "host",
    path: str = "path",
    verdict: str = "verdict",
    default: str = "allow",
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` and ``verdict``; columns of those names are
    replaced.

    ``rules`` has a ``host`` without port, a ``path`` and a ``verdict`` (``allow`` or ``block``). A
    rule fits URLs of its host and of all subdomains whose path begins with the rule's. The rule
    with most characters wins, of equal ones that with the longer host; a rule given both ways
    blocks. ``rule`` is its host and path. Where no rule fits, ``rule`` is NULL and the verdict is
    ``default``. A URL that is NULL or has no ``://`` has an empty host and path, and no rule.
    Repeated pages come out alike. Rules with a NULL or an empty host fit nothing; with no rules,
    or no pages, the result is as long as the pages. Nothing is cut off long URLs.
    """
    rows = packed(pages, _url=url)
    rows = rows.select("_row", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    rows = rows.withColumn("_url", F.concat("_host", "_path"))
    different = rows.filter("_host <> ''").groupBy("_host", "_path").agg(F.lit(1))
    named = different.select(F.col("_host").alias("host"), F.col("_path").alias("path"))
    found = longest_rules(named, _intervals(rules, host, path, verdict))
    found = found.select(
        F.col("url").alias("_url"), F.col("rule").alias("_rule"), F.col("verdict").alias("_verdict")
    )
    joined = lookup_join(rows, found, "_url")
    return joined.select(
        *unpacked(rows, "host", "path", "rule", "verdict"),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.lit(default)).alias("verdict"),
    )
