"""Sources and sinks: XML dumps, archives, manifests, Unicode data files, failures, exports with checksums."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The attributes of each dump table, whether it must be there, and history types that carry text.
DUMP_COLUMNS = {
    "Posts": ("Id", "PostTypeId", "ParentId", "Title", "Body", "Tags", "AcceptedAnswerId", "AnswerCount", "CommentCount", "ContentLicense"),
    "Comments": ("Id", "PostId", "Text", "UserId", "ContentLicense"),
    "PostHistory": ("Id", "PostId", "PostHistoryTypeId", "Text", "RevisionGUID", "ContentLicense"),
    "PostLinks": ("Id", "PostId", "RelatedPostId", "LinkTypeId"),
}
REQUIRED_TABLES = ("Posts", "Comments")
TEXT_HISTORY_TYPES = ("1", "2", "4", "5", "7", "8")
SYNTHETIC_POSTS = ("1000000001", "1000000010")
ALLOWED_HOSTS = r"^https://([a-z0-9-]+\.)*(stackexchange|stackoverflow|superuser|serverfault|askubuntu|archive)\.(com|org|net)(/|$)"


#: Longest row of a dump, in characters.
MOST_ROW_CHARS = 4 << 20


def dump_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Rows of a dump file (plain or .gz), every attribute a string, absent ones null; a row beyond MOST_ROW_CHARS is an error."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in DUMP_COLUMNS[table]])
    reader = spark.read.format("xml").option("rowTag", "row").option("attributePrefix", "").option("mode", "FAILFAST")
    rows = reader.schema(schema).load(path)
    size = sum((F.coalesce(F.length(c), F.lit(0)) for c in DUMP_COLUMNS[table][1:]), F.coalesce(F.length(DUMP_COLUMNS[table][0]), F.lit(0)))
    first = DUMP_COLUMNS[table][0]
    return rows.withColumn(first, F.when(size > MOST_ROW_CHARS, F.raise_error(F.lit("a row is larger than 4 MiB")).cast("string")).otherwise(F.col(first)))


def inventory(spark: SparkSession, folder: str) -> dict[str, str]:
    """The dump files of a folder by table; a missing required table is an error, a missing optional one isn't."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    found = {t: f"{folder.rstrip('/')}/{n}" for t in DUMP_COLUMNS for n in names if n.lower() in (f"{t}.xml".lower(), f"{t}.xml.gz".lower())}
    if missing := [t for t in REQUIRED_TABLES if t not in found]:
        raise FileNotFoundError(f"missing tables: {', '.join(missing)}")
    return found


def without_declarations(spark: SparkSession, path: str) -> bool:
    """True if no line of the file declares a document type or an entity; attributes can't hold such a declaration, their < is escaped."""
    return spark.read.text(path).where(F.col("value").rlike(r"<!(DOCTYPE|ENTITY)")).isEmpty()


def right_root(spark: SparkSession, path: str, table: str) -> bool:
    """True if the file's document element is the table's, in any case."""
    opening = spark.read.text(path).where(F.col("value").rlike(r"<[A-Za-z]")).limit(1).select(F.lower(F.regexp_extract("value", r"<([A-Za-z]+)", 1)).alias("root")).first()
    return opening is not None and opening["root"] == table.lower()


def manifest_of(catalog: DataFrame, release: str, sites: list[str] | None = None) -> DataFrame:
    """Catalog entries (release, site, archive, files, sha256, bytes) of a release as a manifest, checked, in the catalog's order."""
    own = catalog.where(F.col("release") == release)
    if sites is not None:
        own = own.where(F.col("site").isin(*sites))
    return valid_sites(own.withColumn("archive", F.nullif(F.trim("archive"), F.lit("")))).orderBy("ordinal")


def routable_posts(posts: DataFrame) -> DataFrame:
    """Questions and answers with their thread: (id, qid, kind)."""
    kept = posts.where(F.col("PostTypeId").isin("1", "2") & ~F.col("Id").isin(*SYNTHETIC_POSTS))
    question = F.col("PostTypeId") == "1"
    return kept.select(F.col("Id").cast("long").alias("id"), F.when(question, F.col("Id")).otherwise(F.col("ParentId")).cast("long").alias("qid"), F.when(question, 1).otherwise(2).alias("kind"), *[F.col(c) for c in ("Title", "Body", "Tags", "AcceptedAnswerId", "AnswerCount", "CommentCount")])


def text_history(history: DataFrame) -> DataFrame:
    return history.where(F.col("PostHistoryTypeId").isin(*TEXT_HISTORY_TYPES))


def duplicate_links(links: DataFrame) -> DataFrame:
    return links.where(F.col("LinkTypeId") == "3").select(F.col("PostId").cast("long").alias("a"), F.col("RelatedPostId").cast("long").alias("b"))


def fields(kind: Column) -> Column:
    """The text fields of a row by its kind; absent ones are empty."""
    c = lambda n: F.coalesce(F.col(n), F.lit(""))
    empty = F.lit("")
    post = kind == "post"
    return F.struct(*[F.when(post, c(n)).otherwise(empty).alias(n) for n in ("Title", "Body", "Tags")], F.when(post, empty).otherwise(c("Text")).alias("Text"))


def valid_sites(manifest: DataFrame) -> DataFrame:
    """Manifest rows with an ``error`` (null: valid): host, exactly one of archive and files, digest shape."""
    archive, files = F.col("archive").isNotNull(), F.size(F.coalesce("files", F.array().cast("array<string>"))) > 0
    urls = F.concat(F.array_compact(F.array("archive")), F.coalesce("files", F.array().cast("array<string>")))
    error = (
        F.when(~F.coalesce(F.col("site").rlike(r"^[a-z0-9.-]+$"), F.lit(False)), "site")
        .when(archive == files, "one of archive and files")
        .when(~F.forall(urls, lambda u: u.rlike(ALLOWED_HOSTS)), "host")
        .when(F.col("sha256").isNotNull() & ~F.col("sha256").rlike("^[0-9a-f]{64}$"), "sha256")
    )
    return manifest.withColumn("error", error)


def pinned(files: DataFrame, pins: DataFrame) -> DataFrame:
    """Binary files against their pins: path, digest, status (new, same, changed)."""
    own = files.select("path", F.sha2("content", 256).alias("digest"))
    joined = own.join(pins.select("path", F.col("digest").alias("_pin")), "path", "left")
    return joined.select("path", "digest", F.when(F.col("_pin").isNull(), "new").when(F.col("_pin") == F.col("digest"), "same").otherwise("changed").alias("status"))


def failure_rows(raw: DataFrame) -> DataFrame:
    """Failure intake with old column names accepted, counts of at least 1, severities from 1 to 5."""
    has = lambda *names: F.coalesce(*[F.col(n) for n in names if n in raw.columns], F.lit(None))
    return raw.select(
        F.trim(has("query")).alias("query"),
        has("target_kind", "victim_kind").cast("string").alias("target_kind"),
        has("target_key", "victim_key").cast("string").alias("target_key"),
        F.coalesce(has("thief_keys").cast("array<string>"), F.array().cast("array<string>")).alias("thief_keys"),
        F.greatest(F.lit(1), F.coalesce(has("count").cast("long"), F.lit(1))).alias("count"),
        F.least(F.lit(5), F.greatest(F.lit(1), F.coalesce(has("severity").cast("int"), F.lit(1)))).alias("severity"),
        F.coalesce(has("source").cast("string"), F.lit("file")).alias("source"),
    )


def unicode_ranges(lines: DataFrame) -> DataFrame:
    """(low, high, name) of a ``low..high; name`` file; comments and blank lines out."""
    bare = lines.select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("value")).where("value <> ''")
    part = F.split("value", r"\s*;\s*")
    span = F.split(part[0], r"\.\.")
    number = lambda h: F.conv(h, 16, 10).cast("long")
    return bare.select(number(span[0]).alias("low"), number(F.coalesce(F.get(span, F.lit(1)), span[0])).alias("high"), F.trim(part[1]).alias("name"))


def grouped_lines(lines: DataFrame, number: str, prefix: str) -> DataFrame:
    """Every data line with the latest ``prefix`` header above it."""
    header = F.when(F.col("value").startswith(prefix), F.trim(F.expr(f"substring(value, {len(prefix) + 1})")))
    # a file of headers and lines is walked as a whole; partition by file where there are several
    carried = F.last(header, ignorenulls=True).over(W.partitionBy("file").orderBy(number).rowsBetween(W.unboundedPreceding, 0))
    return lines.withColumn("header", carried).where(~F.col("value").startswith("#") & (F.trim("value") != ""))


def emoji_rows(lines: DataFrame) -> DataFrame:
    """(sequence, cp, status, name, emoji_group, subgroup) of an official emoji list (file, n, value).

    ``cp`` is set for single characters, with or without a variation selector.
    """
    by = W.partitionBy("file").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    named = lines.withColumns({f"_{g}": F.when(F.col("value").startswith(f"# {g}:"), F.trim(F.regexp_replace("value", f"^# {g}:", ""))) for g in ("group", "subgroup")})
    carried = named.withColumns({"emoji_group": F.last("_group", ignorenulls=True).over(by), "subgroup": F.last("_subgroup", ignorenulls=True).over(by)})
    data = carried.where(~F.col("value").startswith("#") & F.contains("value", F.lit(";")))
    pattern = r"^([0-9A-F ]+?)\s*;\s*([a-z-]+)\s*#\s*\S+\s+E[0-9.]+\s+(.*)$"
    parts = [F.trim(F.regexp_extract("value", pattern, k)) for k in (1, 2, 3)]
    rows = data.select(parts[0].alias("sequence"), parts[1].alias("status"), parts[2].alias("name"), "emoji_group", "subgroup")
    single = F.regexp_extract("sequence", r"^([0-9A-F]+)(?: FE0[EF])?$", 1)
    return rows.where("sequence <> ''").withColumn("cp", F.when(single != "", F.conv(F.nullif(single, F.lit("")), 16, 10).cast("long")))


def export_jsonl(df: DataFrame, path: str) -> None:
    """Publish as JSON lines; an existing target is an error, and the committer makes it appear whole."""
    df.write.mode("errorifexists").json(path)


def export_framed(rows: DataFrame, path: str, header: dict, by: str, source: str) -> DataFrame:
    """Publish rows between a header and a trailer, each a JSON line in a folder of its own; the trailer, which is the result.

    The trailer counts what stands in the written rows, by ``by``, and comes last: an export without one is not complete.
    """
    spark = rows.sparkSession
    export_jsonl(spark.createDataFrame([("manifest", json.dumps({**header, "export_complete": False}, sort_keys=True, ensure_ascii=False))], "type string, header string").coalesce(1), f"{path}/header")
    export_jsonl(rows, f"{path}/rows")
    counts = spark.read.schema(rows.schema).json(f"{path}/rows").groupBy(F.col(by).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    named = F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("k", F.lit("")), "n"))))
    trailer = counts.agg(F.lit("summary").alias("type"), F.coalesce(F.sum("n"), F.lit(0)).alias("items"), named.alias(f"{by}s"), F.lit(True).alias("export_complete"), F.lit(source).alias("denominator"))
    export_jsonl(trailer.coalesce(1), f"{path}/trailer")
    return spark.read.schema(trailer.schema).json(f"{path}/trailer")


def export_valid(rows: DataFrame, path: str, errors: str = "errors") -> DataFrame:
    """Publish rows without errors as ``records`` and the others, with theirs, as ``excluded``; the manifest of both."""
    spark = rows.sparkSession
    export_jsonl(rows.where(F.size(errors) == 0).drop(errors), f"{path}/records")
    export_jsonl(rows.where(F.size(errors) > 0), f"{path}/excluded")
    return artifact_manifest(spark, {name: f"{path}/{name}" for name in ("records", "excluded")})


def artifact_manifest(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(artifact, files, bytes, sha256) of written artifacts; the digest is over the sorted digests of the parts."""
    out = None
    for name, path in paths.items():
        parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        row = parts.select(F.sha2("content", 256).alias("d"), F.length("content").alias("n")).agg(
            F.count(F.lit(1)).alias("files"), F.sum("n").alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("sha256")
        )
        row = row.select(F.lit(name).alias("artifact"), "files", "bytes", "sha256")
        out = row if out is None else out.unionByName(row)
    return out


def upsert_script(rows: DataFrame, table: str, key: str, columns: list[str]) -> DataFrame:
    """One upsert statement for each row, quotes doubled, null as NULL."""
    literal = lambda c: F.when(F.col(c).isNull(), "NULL").otherwise(F.concat(F.lit("'"), F.replace(F.col(c).cast("string"), F.lit("'"), F.lit("''")), F.lit("'")))
    names = ", ".join([key, *columns])
    sets = ", ".join(f"{c} = excluded.{c}" for c in columns)
    values = F.concat_ws(", ", *[literal(c) for c in (key, *columns)])
    return rows.select(F.concat(F.lit(f"INSERT INTO {table} ({names}) VALUES ("), values, F.lit(f") ON CONFLICT ({key}) DO UPDATE SET {sets};")).alias("value"))
