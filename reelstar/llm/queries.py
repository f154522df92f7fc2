"""The operators as queries over the given tables, and SQL for those it can express."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstar.llm import (
    alignment,
    collocations,
    decontaminate,
    importance,
    langid,
    licences,
    linededup,
    mixing,
    neighbours,
    sharding,
    simhash,
    urlrules,
    warc,
)

# The rules of the URL filter
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item of which it holds a passage, in its nearest form."""
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    placed = sharding.kd_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(part == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out).select("text", "lang"))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return langid.identify(rows, model).drop("text")


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical digest of every document, and the licence it is."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs).select("doc_id", "digest", "licence")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of all documents takes of each."""
    mix = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that repeat a window of an earlier one, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = linededup.dedup_lines(docs)
    return left.select("doc_id", "n_lines", "lines_removed", F.md5("text").alias("text_md5"))


def op7_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every document, towards those labelled good and not toxic."""
    labels = table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0")
    return importance.resample(table(spark, sf_dir, "documents"), labels)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page, with digests in place of their blocks."""
    records = warc.derivatives(warc.responses_of(table(spark, sf_dir, "pages")))
    return records.select(
        "record_id", "record_type", "refers_to", "target_uri", "date", "content_type",
        "content_length", "block_digest", "source_payload_digest", F.md5("headers").alias("headers_md5"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of every document by two tokenizers overlap."""
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    found = alignment.align(table(spark, sf_dir, "documents"), shown=digest)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_kd_sharding": op2_kd_sharding,
        "op3_language": op3_language,
        "op4_licence_scan": op4_licence_scan,
        "op5_mixing": op5_mixing,
        "op6_line_dedup": op6_line_dedup,
        "op7_importance": op7_importance,
        "op8_neighbours": op8_neighbours,
        "op9_warc_derivatives": op9_warc_derivatives,
        "op10_simhash": op10_simhash,
        "op11_alignment": op11_alignment,
        "op12_collocations": op12_collocations,
        "op13_url_filter": op13_url_filter,
    }


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('7:' || coalesce(cast(doc_id AS varchar), '')) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::bigint AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM docs GROUP BY source),
by_ratio AS (
  SELECT *, row_number() OVER w AS k,
         sum(source_size * 2.0::double) OVER w AS held,
         sum(weight) OVER () - sum(weight) OVER w AS free
  FROM sources WINDOW w AS (ORDER BY source_size / weight::double, source NULLS LAST
                            ROWS UNBOUNDED PRECEDING)),
levels AS (
  SELECT 0 AS k, 1.5::double * sum(source_size)::double / sum(weight) AS level FROM sources
  UNION ALL
  SELECT k, CASE WHEN free > 0 THEN
           (1.5::double * (SELECT sum(source_size) FROM sources)::double - held) / free END
  FROM by_ratio),
filled AS (
  SELECT level FROM levels l
  WHERE level IS NULL OR NOT EXISTS (
    SELECT 1 FROM by_ratio b WHERE b.k > l.k AND b.weight * l.level > b.source_size * 2.0::double)
  ORDER BY l.k LIMIT 1),
targets AS (
  SELECT s.*, CASE WHEN f.level IS NULL OR s.weight * f.level > s.source_size * 2.0::double
                   THEN s.source_size * 2.0::double ELSE s.weight * f.level END AS target
  FROM sources s, filled f),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::int ELSE 0 END AS epochs
  FROM targets),
running AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY place, d.size
                           ROWS UNBOUNDED PRECEDING) - d.size / 2.0::double AS reached
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size::bigint AS size, source_size, target,
       (size * (epochs + CASE WHEN reached <= target - epochs * source_size THEN 1 ELSE 0 END))::bigint
         AS taken
FROM running
"""


def _op4_sql() -> str:
    """The canonical form as nested replacements, over documents and the known texts alike."""
    form = "chr(10) || translate(text, '{}', '{}') || chr(10)".format(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    for pattern, new in licences.RULES:
        new = re.sub(r"\$\{(\d)\}", r"\\\1", new)
        new = "chr(10)" if new == "\n" else f"'{new}'"
        pattern = pattern.replace("'", "''")
        form = f"regexp_replace({form}, '{pattern}', {new}, 'g')"
    texts = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licences.known_texts()
    )
    return f"""
WITH known AS (
  SELECT md5(trim({form})) AS digest, min(licence) AS licence
  FROM (VALUES {texts}) AS t(licence, text) GROUP BY 1),
docs AS (SELECT doc_id, md5(trim({form})) AS digest FROM documents)
SELECT doc_id, digest, licence FROM docs LEFT JOIN known USING (digest)
"""


OP6_SQL = """
WITH docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
places AS (
  SELECT doc_id, lines, unnest(range(len(lines) - 2)) AS pos FROM docs WHERE len(lines) >= 3),
windows AS (
  SELECT doc_id, pos, md5(lines[pos + 1]) || md5(lines[pos + 2]) || md5(lines[pos + 3]) AS h
  FROM places),
numbered AS (
  SELECT doc_id, pos, first_value(doc_id) OVER w AS first_doc, first_value(pos) OVER w AS first_pos
  FROM windows WINDOW w AS (PARTITION BY h ORDER BY doc_id NULLS LAST, pos)),
later AS (
  SELECT doc_id, pos,
         CASE WHEN doc_id = first_doc THEN greatest(pos, first_pos + 3) ELSE pos END AS clear
  FROM numbered WHERE doc_id <> first_doc OR pos <> first_pos),
covered AS (
  SELECT doc_id, list(DISTINCT line) AS gone
  FROM (SELECT doc_id, unnest(range(clear, pos + 3)) AS line FROM later) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(lines), 0)::int AS n_lines, coalesce(len(gone), 0)::int AS lines_removed,
       CASE WHEN gone IS NULL THEN md5(text)
            ELSE md5(array_to_string(
              [lines[i + 1] FOR i IN range(len(lines)) IF NOT list_contains(gone, i)],
              chr(10))) END AS text_md5
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id
"""


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
spans AS (
  SELECT lang, w, unnest([1, 2, 3, 4]) AS m FROM cut),
places AS (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM spans WHERE len(w) >= m),
freq AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, m, count(*) AS f
  FROM places GROUP BY ALL),
totals AS (SELECT lang, sum(f)::bigint AS n FROM freq WHERE m = 1 GROUP BY lang),
cand AS (
  SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM freq WHERE m >= 2 AND f >= 30),
subs AS (
  SELECT lang, a, w, k, unnest(range(1, m - k + 2)) AS i
  FROM (SELECT *, unnest(range(2, m)) AS k FROM cand)),
inner_ AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS longer
  FROM subs GROUP BY ALL),
kept AS (
  SELECT c.* FROM cand c LEFT JOIN inner_ i USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer::hugeint < 80 * a::hugeint),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         ((2000000::hugeint * c.a) // (x.f + y.f))::bigint AS score
  FROM cuts c
  JOIN freq x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN freq y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT row_number() OVER () AS row, page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut),
rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
fits AS (
  SELECT row, rule_host || rule_path AS rule, verdict FROM named JOIN rules
    ON (host = rule_host OR suffix(host, '.' || rule_host)) AND prefix(path, rule_path)),
best AS (
  SELECT * FROM fits QUALIFY row_number() OVER (PARTITION BY row ORDER BY length(rule) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM named LEFT JOIN best USING (row)
"""


def llm_oracles() -> dict[str, str]:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return {
        "op4_licence_scan": _op4_sql(),
        "op5_mixing": OP5_SQL,
        "op6_line_dedup": OP6_SQL,
        "op12_collocations": OP12_SQL,
        "op13_url_filter": OP13_SQL.replace("{rules}", rules),
    }
