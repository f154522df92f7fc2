"""Bronze: raw JSON per endpoint and day.

Layout: ``{root}/{endpoint}/year=YYYY/month=MM/day=DD/[media_id=ID/]``. Two kinds of file live
there: ``*.json`` documents as an API client stores them (one object, or one array per page,
possibly over several lines) and ``*.txt.gz`` with one object per line, as ``write_bronze``
stores them. A folder per video suits a client that stores page after page; rows written by
Spark carry the id themselves, so many videos can share a file.

Folders are listed through the session's JVM, so a classic session is needed, not a Connect one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from reelstar.functions import columns as C
from reelstar.schemas import BROKEN, FILES, RAW
from reelstar.session import empty_frame

DOCUMENTS = "*.json"
LINES = "*.txt.gz"
_DAY_FOLDER = r"/year=(\d{4})/month=(\d{2})/day=(\d{2})/"


def day_path(root: str, endpoint: str, run_date: str) -> str:
    """``run_date`` is an ISO date; one argument for the whole run, so midnight changes nothing."""
    year, month, day = run_date.split("-")
    return f"{root.rstrip('/')}/{endpoint}/year={year}/month={month}/day={day}"


def document_key(endpoint: str, media_id: str, run_date: str, page: int | None = None) -> str:
    """Name of one landed document, relative to the bronze root."""
    name = f"{media_id}.json" if page is None else f"page_{page:05d}.json"
    return f"{day_path('', endpoint, run_date).lstrip('/')}/media_id={media_id}/{name}"


def empty(spark: SparkSession, endpoint: str) -> DataFrame:
    """No documents: the endpoint's schema with zero rows."""
    return empty_frame(spark, RAW[endpoint])


def _existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Folders among ``paths`` that exist: the days of a run, so a short list."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        location = jvm.org.apache.hadoop.fs.Path(path)
        if location.getFileSystem(conf).exists(location):
            found.append(path)
    return found


def files(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """Files of an endpoint: ``endpoint``, ``path``, ``modified`` and the ``day`` of their folder.

    Spark lists the tree and looks at no content. Files outside the folder of a day are left out.
    """
    base = f"{root.rstrip('/')}/{endpoint}"
    if not _existing(spark, [base]):
        return empty_frame(spark, FILES)
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"{{{DOCUMENTS},{LINES}}}")
        .load(base)
    )
    path = F.col("_metadata.file_path")
    parts = [F.regexp_extract(path, _DAY_FOLDER, k) for k in (1, 2, 3)]
    return listing.select(
        F.lit(endpoint).alias("endpoint"),
        path.alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.concat_ws("-", *parts).alias("day"),
    ).filter("day <> '--'")


def read_bronze(
    spark: SparkSession,
    root: str,
    endpoint: str,
    run_dates: Sequence[str],
    keep_broken: bool = False,
) -> DataFrame:
    """All documents of an endpoint for the given days.

    A document that is no JSON gives a row of NULLs. With ``keep_broken`` its text is in a column
    ``_broken``, which is NULL for all others.

    A day without a folder contributes nothing; any other read error is raised. Naming the day
    folders prunes the listing to them. Partition columns are not discovered: events carry
    their own media_id, and the statistics take theirs from the file path.
    """
    schema = with_broken(RAW[endpoint]) if keep_broken else RAW[endpoint]
    paths = _existing(spark, [day_path(root, endpoint, d) for d in run_dates])
    if not paths:
        return empty_frame(spark, schema)
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    if keep_broken:
        reader = reader.option("columnNameOfCorruptRecord", BROKEN)
    documents = reader.option("multiLine", True).option("pathGlobFilter", DOCUMENTS).json(paths)
    lines = reader.option("multiLine", False).option("pathGlobFilter", LINES).json(paths)
    if endpoint == "media_stats":
        # a path is shown percent-encoded; in folders that Spark wrote, names are encoded besides
        once = _decoded(C.media_id_from_path(F.col("_metadata.file_path")))
        documents, lines = (
            df.withColumn("media_id", F.coalesce("media_id", F.nullif(name, F.lit(""))))
            for df, name in ((documents, once), (lines, _decoded(once)))
        )
    return documents.unionByName(lines)


def read_variants(
    spark: SparkSession, root: str, endpoint: str, run_dates: Sequence[str]
) -> DataFrame:
    """Documents of the given days as VARIANT: ``resource``, ``day`` and ``doc``.

    An array, as a page is, gives its elements. Text that is no JSON gives no row; the typed scan
    counts it.
    """
    paths = _existing(spark, [day_path(root, endpoint, d) for d in run_dates])
    if not paths:
        none = spark.range(0)
        return none.select(*[F.lit("").alias(c) for c in ("resource", "day")], F.parse_json(F.lit("{}")).alias("doc"))
    reader = spark.read.option("recursiveFileLookup", True)
    documents = reader.option("pathGlobFilter", DOCUMENTS).text(paths, wholetext=True)
    lines = reader.option("pathGlobFilter", LINES).text(paths)
    path = F.col("_metadata.file_path")
    day = F.concat_ws("-", *[F.regexp_extract(path, _DAY_FOLDER, k) for k in (1, 2, 3)])
    texts = documents.select(day.alias("day"), "value").unionByName(lines.select(day.alias("day"), "value"))
    parsed = texts.select("day", F.try_parse_json("value").alias("v")).filter("v IS NOT NULL")
    is_page = F.schema_of_variant("v").startswith("ARRAY")
    page = F.when(is_page, F.expr("CAST(v AS array<variant>)")).otherwise(F.array("v"))
    rows = parsed.select(F.lit(endpoint).alias("resource"), "day", F.explode(page).alias("doc"))
    return rows.filter(F.schema_of_variant("doc").startswith("OBJECT"))


def _decoded(name: Column) -> Column:
    """Percent-decoded text, or as it is where that makes no sense; a plus is a plus."""
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def with_broken(schema: StructType) -> StructType:
    """The schema with a column for the text of documents that do not fit it."""
    return StructType([*schema.fields, StructField(BROKEN, StringType())])


def write_bronze(
    df: DataFrame,
    root: str,
    endpoint: str,
    run_date: str,
    media_id: str | None = None,
    replace: bool = False,
) -> None:
    """Store rows of an endpoint as JSON lines under their day.

    Rows are appended under new file names, so a second run of a day adds its newer rows and
    loses none; ``replace`` is for the endpoints that are pulled whole. ``media_id`` names a
    column to lay the day out by, one folder per video: only for few videos, as each costs a
    file. The rebalance then gathers a video's rows and splits the files of a hot one.
    """
    year, month, day = run_date.split("-")
    parts = {"year": F.lit(year), "month": F.lit(month), "day": F.lit(day)}
    if media_id is not None:
        parts["media_id"] = F.col(media_id)
    line = F.to_json(F.struct(*RAW[endpoint].names)).alias("value")
    lines = df.select(line, *[c.alias(name) for name, c in parts.items()])
    if media_id is not None:
        lines = lines.hint("rebalance", "media_id")
    (
        lines.write.partitionBy(*parts)
        .mode("overwrite" if replace else "append")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        # a gzip file is read by one task
        .option("maxRecordsPerFile", 1_000_000)
        .text(f"{root.rstrip('/')}/{endpoint}")
    )


def read_landing(
    spark: SparkSession,
    root: str,
    endpoint: str,
    run_dates: Sequence[str] | None = None,
    multiline: bool = True,
    keep_broken: bool = False,
) -> DataFrame:
    """Fetched pages of a paged endpoint, one output row per element.

    A landed page is ``{"media_id": .., "page": n, "rows": [..]}``: one per file, or with
    ``multiline=False`` one per line. With ``run_dates`` only the folders of those days are read,
    laid out like bronze. Output: media_id of the request as ``request_media_id``, ``page``,
    ``pos`` in the page, and the endpoint's fields. With ``keep_broken`` a page that is no JSON
    gives one row that holds its text in ``_broken`` and NULLs besides.
    """
    paths = [f"{root.rstrip('/')}/{endpoint}"]
    if run_dates is not None:
        paths = [day_path(root, endpoint, d) for d in run_dates]
    paths = _existing(spark, paths)
    schema = StructType().add("media_id", "string").add("page", "integer")
    schema = with_broken(schema.add("rows", ArrayType(RAW[endpoint])))
    if paths:
        reader = spark.read.schema(schema).option("recursiveFileLookup", True)
        reader = reader.option("columnNameOfCorruptRecord", BROKEN)
        pages = reader.option("multiLine", multiline).json(paths)
    else:
        pages = empty_frame(spark, schema)
    if keep_broken:
        # rows read before the place where a page breaks off are not to be trusted either
        kept = F.when(F.col(BROKEN).isNull(), F.col("rows"))
        element = F.posexplode_outer(kept).alias("pos", "row")
        whole = F.col(BROKEN).isNotNull() | F.col("row").isNotNull()
    else:
        element, whole = F.posexplode("rows").alias("pos", "row"), F.lit(True)
    rows = pages.select(F.col("media_id").alias("request_media_id"), "page", element, BROKEN)
    out = rows.filter(whole).select("request_media_id", "page", "pos", "row.*", BROKEN)
    return out if keep_broken else out.drop(BROKEN)
