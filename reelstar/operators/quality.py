"""Data-quality checks as aggregates, reported as rows of one long frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from reelstar.operators.joins import lookup_join
from reelstar.schemas import KEYS, LOAD_ORDER, MAX_LENGTH, RULES, STAR, not_null_columns

# columns of every report, in order
REPORT = ("table", "check", "column", "value", "threshold", "status")


class QualityGateError(RuntimeError):
    """At least one check failed; ``failures`` holds the failed report rows."""

    def __init__(self, failures: list) -> None:
        self.failures = failures
        lines = [f"{r['table']}.{r['column'] or '*'} {r['check']}={r['value']}" for r in failures]
        super().__init__("quality gate failed: " + "; ".join(lines))


def _line(table: str, check: str, column: str | None, value: str, limit, ok: str) -> str:
    """SQL text of one report row; ``value`` and ``ok`` are expressions."""
    named = f"'{column}'" if column else "CAST(NULL AS string)"
    limit = "NULL" if limit is None else limit
    return (
        f"('{table}', '{check}', {named}, CAST({value} AS double), CAST({limit} AS double), "
        f"IF({ok}, 'ok', 'fail'))"
    )


def _rows(one_row: DataFrame, lines: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The row's aggregates laid out as one output row per line.

    A line casts every aggregate it shows: a bare column would give its struct a field name of
    its own, and the lines would differ in type.
    """
    columns = ", ".join(f"`{n}`" for n in names)
    return one_row.selectExpr(f"inline(array({', '.join(lines)})) AS ({columns})")


def null_key_report(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows read, kept and dropped by the null-key filter, from one pass."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(complete).alias("rows_kept"),
        F.count_if(~complete).alias("rows_dropped"),
    ).select(F.lit(table).alias("table"), "rows_read", "rows_kept", "rows_dropped")


def null_profile(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and percentage of every column, all from one aggregate."""
    columns = list(columns or df.columns)
    counts = df.selectExpr(
        "count(*) AS n", *[f"count_if(`{c}` IS NULL) AS `null_{c}`" for c in columns]
    )
    lines = [
        f"('{table}', '{c}', n, CAST(`null_{c}` AS bigint), "
        f"round(try_divide(`null_{c}`, n) * 100, 2))"
        for c in columns
    ]
    return _rows(counts, lines, ("table", "column", "row_count", "null_count", "null_pct"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter(F.col("n_rows") > 1)


def orphan_facts(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """Facts whose video is unknown; facts without a video are not orphans."""
    keyed = fact.filter(F.col("event_key").isNotNull() & F.col("media_id").isNotNull())
    known = dim_media.select("media_id").filter(F.col("media_id").isNotNull())
    return lookup_join(keyed, known, "media_id", "left_anti").select(*fact.columns)


def orphan_count(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """Number of orphan facts; facts are counted per video before they meet the dimension.

    The counts lie by video already, so only the dimension's ids are shuffled, and none broadcast.
    """
    per_media = (
        fact.filter(F.col("event_key").isNotNull() & F.col("media_id").isNotNull())
        .groupBy("media_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = dim_media.select("media_id").filter(F.col("media_id").isNotNull())
    lost = per_media.join(known.hint("merge"), "media_id", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))


def constraint_violations(df: DataFrame, table: str) -> DataFrame:
    """Rows that break a declared NOT NULL, VARCHAR length or decimal range, per constraint.

    One pass. A length is one of bytes. A decimal column may still be text or a double here: its
    limit is the first number that the declared type cannot hold.
    """
    rules = [("not_null", c, "NULL", f"{c} IS NULL") for c in not_null_columns(table)]
    rules += [
        ("max_length", c, str(n), f"octet_length({c}) > {n}")
        for c, n in MAX_LENGTH[table].items()
        if c in df.columns
    ]
    for field in STAR[table].fields:
        if isinstance(field.dataType, DecimalType) and field.name in df.columns:
            limit = 10 ** (field.dataType.precision - field.dataType.scale)
            over = f"coalesce(abs(try_cast({field.name} AS double)) >= {limit}, false)"
            rules.append(("decimal_range", field.name, str(limit), over))
    counts = df.selectExpr(*[f"count_if({bad}) AS {rule}_{c}" for rule, c, _, bad in rules])
    lines = [
        f"('{table}', '{rule}', '{c}', CAST({limit} AS bigint), CAST({rule}_{c} AS bigint))"
        for rule, c, limit, _ in rules
    ]
    return _rows(counts, lines, ("table", "constraint", "column", "limit", "violations"))


def table_report(
    df: DataFrame,
    table: str,
    dropped: int | None = None,
    max_null_pct: dict[tuple[str, str], float] | None = None,
) -> DataFrame:
    """Every single-table rule except uniqueness: one scan, one aggregate.

    Null percentages are taken over the rows that have a key and compared unrounded. Next to
    them stands the number of rows dropped for a missing key: ``dropped``, which the build
    counted before it dropped them, and those that ``df`` still holds. ``max_null_pct`` has limits
    of a feed per table and column, in place of those of the rules.
    """
    key, rules = KEYS[table], RULES[table]
    has_key = f"{key} IS NOT NULL" if key in df.columns else "true"
    of_feed = max_null_pct or {}
    limits = {
        c: of_feed.get((table, c), pct) for c, pct in rules["max_null_pct"].items() if c in df.columns
    }
    lengths = {c: n for c, n in MAX_LENGTH[table].items() if c in df.columns}
    counts = df.selectExpr(
        f"count_if({has_key}) AS n",
        f"count_if(NOT ({has_key})) + {dropped or 0}L AS dropped",
        *[f"count_if({has_key} AND {c} IS NULL) AS null_{c}" for c in limits],
        *[f"count_if({has_key} AND octet_length({c}) > {n}) AS long_{c}" for c, n in lengths.items()],
    )
    lines = [
        _line(table, "dropped_null_key", key, "dropped", None, "true"),
        _line(table, "min_rows", None, "n", rules["min_rows"], f"n >= {rules['min_rows']}"),
    ]
    for c in rules["required"]:
        has = int(c in df.columns)
        lines.append(_line(table, "required_column", c, str(has), 1, f"{has} = 1"))
    for c, pct in limits.items():
        share = f"try_divide(null_{c}, n) * 100"
        passed = f"coalesce({share} <= {pct}, true)"
        lines.append(_line(table, "null_pct", c, f"round({share}, 2)", pct, passed))
    for c in lengths:
        lines.append(_line(table, "max_length", c, f"long_{c}", 0, f"long_{c} = 0"))
    return _rows(counts, lines, REPORT)


def uniqueness_report(df: DataFrame, table: str) -> DataFrame:
    """Surplus rows of repeated keys: an upsert inserts all of them, so there must be none."""
    surplus = duplicate_keys(df, [KEYS[table]]).selectExpr(
        "coalesce(sum(n_rows - 1), 0) AS surplus"
    )
    line = _line(table, "unique_key", KEYS[table], "surplus", 0, "surplus = 0")
    return _rows(surplus, [line], REPORT)


def integrity_report(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    line = _line(
        "fact_media_engagement", "orphan_media", "media_id", "orphans", 0, "orphans = 0"
    )
    return _rows(orphan_count(fact, dim_media), [line], REPORT)


def quality_report(
    tables: dict[str, DataFrame | None],
    known_media: DataFrame | None = None,
    dropped: dict[str, int] | None = None,
    max_null_pct: dict[tuple[str, str], float] | None = None,
) -> DataFrame | None:
    """Report over the day's tables; a table that did not arrive is skipped, not failed.

    ``known_media`` is the dimension the fact is checked against; without it the day's own.
    ``dropped`` has the rows that a table's build left out for a missing key, ``max_null_pct``
    limits of a feed in place of those of the rules.
    """
    parts = []
    for table in LOAD_ORDER:
        df = tables.get(table)
        if df is None:
            continue
        parts.append(table_report(df, table, (dropped or {}).get(table), max_null_pct))
        if KEYS[table] in df.columns:
            parts.append(uniqueness_report(df, table))
    fact = tables.get("fact_media_engagement")
    media = known_media if known_media is not None else tables.get("dim_media")
    if fact is not None and media is not None:
        parts.append(integrity_report(fact, media))
    return reduce(DataFrame.unionByName, parts) if parts else None


def build_line(
    resource: str, check: str, column: str | None, value: float, limit: float, share: float
) -> Row:
    """A report line of something that the build counted; it fails if ``share`` is over the limit."""
    status = "fail" if share > limit else "ok"
    return Row(*REPORT)(resource, check, column, float(value), float(limit), status)


def gate(report: DataFrame | None, lines: Sequence[Row] = ()) -> list:
    """Collect the report (a few rows per table), add ``lines``, and raise if any check failed."""
    rows = ([] if report is None else report.collect()) + list(lines)
    failures = [r for r in rows if r["status"] == "fail"]
    if failures:
        raise QualityGateError(failures)
    return rows
