"""Scans: record documents, page inventories, manifests, progress lists, wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.recode import is_safe_identifier

ASSEMBLY_SCHEMA = (
    "record_id string, expected_pages int, found_pages int, "
    "pages array<struct<source_file:string,kind:string,image_path:string,tentative_page:int>>, "
    "flags array<string>, status string"
)
MANIFEST_KEYS = ("record_id", "source_path")


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def record_id_of(document: Column, file_name: Column | None = None) -> Column:
    """The stored id, or the file stem where a document has none."""
    stored = F.nullif(F.try_variant_get(document, "$.record_id", "string"), F.lit(""))
    return F.coalesce(stored, file_stem(file_name)) if file_name is not None else stored


def parse_records(raw: DataFrame, body: str = "value", file_name: str | None = "file_name") -> DataFrame:
    """Row-local parse of raw JSON text: (file_name, record_id, document VARIANT, error).

    An unreadable document, or a root that is no object, is a row with an error rather than a failure.
    NaN and Infinity are not JSON and make a document unreadable. Works on streaming frames too.
    """
    document = F.try_parse_json(body)
    name = F.col(file_name) if file_name else F.lit(None).cast("string")
    # Readable JSON that opens with a brace is an object; no need to look into the parsed value.
    opens = F.ltrim(body, F.lit(" \t\r\n")).startswith("{")
    # Through a generator of one row: filters on what a document holds, such as those of joins on ids, stay behind it
    # and do not parse, or build, each document once more.
    parsed = raw.select(F.inline(F.array(F.struct(name.alias("file_name"), document.alias("document"), opens.alias("_object")))))
    record_id = record_id_of(F.col("document"), F.col("file_name") if file_name else None)
    error = (
        F.when(F.col("document").isNull(), "unreadable_json").when(~F.col("_object"), "root_not_object")
        .when(~is_safe_identifier(record_id), "invalid_record_id")
    )
    return parsed.select("file_name", record_id.alias("record_id"), "document", error.alias("error"))


def scan_records(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Record documents below path: one per *.json file, or one per line of any file for large corpora
    (few big files split across tasks, where millions of small files would not)."""
    glob = "*" if one_per_line else "*.json"
    raw = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=not one_per_line)
    named = raw.select(F.col("_metadata.file_name").alias("file_name"), "value")
    return parse_records(named, file_name=None if one_per_line else "file_name")


def valid_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("error").isNull()).select("record_id", "document")


def corrupt_findings(records: DataFrame) -> DataFrame:
    return records.filter(F.col("error").isNotNull()).select(
        F.coalesce("record_id", "file_name").alias("record_id"), F.lit(None).cast("string").alias("qid"),
        F.lit(None).cast("string").alias("path"), F.col("error").alias("rule"), F.col("file_name").alias("detail"),
    )


def parse_assembly(raw: DataFrame, body: str = "value") -> DataFrame:
    """Page inventories, one row per page; a record without pages keeps one row with NULLs:
    (record_id, expected_pages, status, source_file, kind, image_path, tentative_page)."""
    parsed = raw.select(F.from_json(body, ASSEMBLY_SCHEMA).alias("a"))
    return parsed.select("a.record_id", "a.expected_pages", "a.status", F.inline_outer("a.pages"))


def scan_assembly(spark: SparkSession, path: str) -> DataFrame:
    return parse_assembly(spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True))


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """Manifests and progress lists: quoted commas, doubled quotes and line breaks inside quotes; a leading byte order
    mark is dropped. Everything is text; blank lines are skipped. A file is read by one task, as line breaks may be
    part of a cell."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', encoding="UTF-8")


def scan_wide(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A wide table written earlier: Parquet, or CSV of declared types with one record a line, which Spark can split."""
    if not path.rstrip("/").endswith(".csv"):
        return spark.read.parquet(path)
    if schema is None:
        raise ValueError("a wide CSV needs a schema")
    return spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', encoding="UTF-8")


def clean_manifest(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.trim(F.coalesce(name, F.lit(""))) for name in MANIFEST_KEYS})


def manifest_findings(rows: DataFrame) -> DataFrame:
    """Blank keys and repeated ids: (record_id, rule, n)."""
    cleaned = clean_manifest(rows)
    blank = cleaned.filter("record_id = '' or source_path = ''").groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = cleaned.filter("record_id <> ''").groupBy("record_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return blank.select("record_id", F.lit("blank_key").alias("rule"), "n").unionByName(
        repeated.select("record_id", F.lit("duplicate_record_id").alias("rule"), "n")
    )


def load_manifest(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Manifest rows with trimmed keys. strict raises on blank or repeated ids before anything uses them."""
    rows = scan_csv(spark, path)
    if strict:
        problem = manifest_findings(rows).orderBy("rule", "record_id").first()
        if problem:
            raise ValueError(f"manifest: {problem.rule} for record_id {problem.record_id!r}")
    return clean_manifest(rows)


def source_inventory(
    spark: SparkSession, path: str, extensions: tuple[str, ...] = ("jpg", "jpeg", "png", "pdf"), check_header: bool = False
) -> DataFrame:
    """One source file per record id (the file stem), first in sorted path order, from the listing alone.

    check_header also reads the files, whole, to tell damaged ones by their signature; without it `readable` is NULL.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    head = F.hex(F.substring("content", 1, 8)) if check_header else F.lit(None).cast("string")
    named = files.select(
        "path", "length", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("extension"),
        file_stem(F.col("path")).alias("record_id"), head.alias("_head"),
    ).filter(F.col("extension").isin(*extensions))
    # File signatures in hex.
    readable = (
        (F.col("extension").isin("jpg", "jpeg") & F.col("_head").startswith("FFD8FF"))
        | ((F.col("extension") == "png") & F.col("_head").startswith("89504E470D0A1A0A"))
        | ((F.col("extension") == "pdf") & F.col("_head").startswith("25504446"))
    )
    return first_source(named.withColumn("readable", readable), ["path", "extension", "length", "readable"])


def first_source(listing: DataFrame, columns: list[str]) -> DataFrame:
    """Per record the source with the least path, and how many there are."""
    packed = listing.select("record_id", F.struct(*columns).alias("source"))
    best = packed.groupBy("record_id").agg(F.min("source").alias("source"), F.count(F.lit(1)).alias("n_sources"))
    return best.select("record_id", "source.*", "n_sources")
