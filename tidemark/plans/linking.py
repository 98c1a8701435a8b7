"""Linked-file operators on documents, labels, lineitem and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import ColumnRule, Contract, ExternalFile
from tidemark.operators import linked
from tidemark.plans import query, table


def _named(prefix: str, key: str) -> F.Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(".tif"))


# A document row names its scan and its source's cover.
DOCUMENT_CONTRACT = Contract(
    columns={
        "doc_id": ColumnRule("int", non_nullable=True),
        "scan_file": ColumnRule("string", external_file=ExternalFile("scan")),
        "cover_file": ColumnRule("string", external_file=ExternalFile("cover")),
    }
)

_DOCS = """docs AS (
  SELECT doc_id, 'doc_' || doc_id || '.tif' AS scan_file,
         CASE WHEN lang <> 'de' THEN 'cover_' || source || '.tif' END AS cover_file, lang, text
  FROM documents)"""
_FILES = """files AS (
  SELECT 'doc_' || doc_id || '.tif' AS file FROM labels
  UNION ALL SELECT DISTINCT 'cover_' || source || '.tif' FROM documents WHERE lang = 'es')"""
_REFS = """refs AS (
  SELECT DISTINCT 'scan' AS name, scan_file AS file FROM docs WHERE scan_file IS NOT NULL
  UNION SELECT DISTINCT 'cover', cover_file FROM docs WHERE cover_file IS NOT NULL)"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        _named("doc_", "doc_id").alias("scan_file"),
        F.when(F.col("lang") != "de", _named("cover_", "source")).alias("cover_file"),
        "lang",
    )


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scans = table(spark, sf_dir, "labels").select(_named("doc_", "doc_id").alias("file"))
    covers = (
        table(spark, sf_dir, "documents").where(F.col("lang") == "es")
        .select(_named("cover_", "source").alias("file")).distinct()
    )
    return scans.unionByName(covers)


@query(f"WITH {_DOCS}, {_FILES}, {_REFS} SELECT name, file FROM refs WHERE file NOT IN (SELECT file FROM files)")
def linked_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = linked.references(_documents(spark, sf_dir), DOCUMENT_CONTRACT)
    return linked.missing_references(refs, _files(spark, sf_dir))


@query(
    f"WITH {_DOCS}, {_FILES}, {_REFS} SELECT DISTINCT file FROM files WHERE file NOT IN "
    "(SELECT file FROM refs WHERE name = 'cover')"
)
def linked_unreferenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that no document names as its cover."""
    refs = linked.references(_documents(spark, sf_dir).drop("scan_file"), DOCUMENT_CONTRACT)
    return linked.unreferenced_files(refs, _files(spark, sf_dir))


@query(
    f"WITH {_DOCS}, {_FILES}, {_REFS} "
    "SELECT DISTINCT file FROM refs WHERE file IN (SELECT file FROM files)"
)
def linked_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = linked.references(_documents(spark, sf_dir), DOCUMENT_CONTRACT)
    return linked.resolved_references(refs, _files(spark, sf_dir))


@query(
    "SELECT 'scan' AS name, 'doc_' || doc_id || '.tif' AS file, "
    "'images/scan/' || sha256(text) || '.tif' AS relative_path FROM documents"
)
def linked_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document text stands in for the image content."""
    refs = linked.references(_documents(spark, sf_dir).drop("cover_file"), DOCUMENT_CONTRACT)
    digests = table(spark, sf_dir, "documents").select(
        _named("doc_", "doc_id").alias("file"), F.sha2("text", 256).alias("sha256")
    )
    return linked.canonical_mapping(refs, digests)


# A line names the drawing of its part and the logo of its supplier.
LINE_CONTRACT = Contract(
    columns={
        "drawing_file": ColumnRule("string", external_file=ExternalFile("drawing")),
        "logo_file": ColumnRule("string", external_file=ExternalFile("logo")),
    }
)


@query(
    """WITH drawings AS (SELECT p_partkey, 'images/drawing/' || p_name || '_' || p_partkey || '.tif' AS path
                         FROM part WHERE p_size > 25)
    SELECT l_orderkey, l_linenumber, l_partkey, path AS drawing_relative_path,
           CASE WHEN s_acctbal >= 0 THEN 'images/logo/' || s_name || '.tif' END AS logo_relative_path
    FROM lineitem LEFT JOIN drawings ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey"""
)
def linked_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        _named("part_", "l_partkey").alias("drawing_file"),
        _named("supplier_", "l_suppkey").alias("logo_file"),
    )
    drawings = table(spark, sf_dir, "part").where(F.col("p_size") > 25).select(
        F.lit("drawing").alias("name"), _named("part_", "p_partkey").alias("file"),
        F.format_string("images/drawing/%s_%s.tif", "p_name", F.col("p_partkey").cast("string"))
        .alias("relative_path"),
    )
    logos = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") >= 0).select(
        F.lit("logo").alias("name"), _named("supplier_", "s_suppkey").alias("file"),
        F.format_string("images/logo/%s.tif", "s_name").alias("relative_path"),
    )
    attached = linked.attach_canonical_paths(lines, drawings.unionByName(logos), LINE_CONTRACT)
    return attached.select(
        "l_orderkey", "l_linenumber", "l_partkey", "drawing_relative_path", "logo_relative_path"
    )


@query(
    f"""WITH {_DOCS}, {_FILES}
    SELECT doc_id,
           CASE WHEN scan_file IN (SELECT file FROM files) THEN scan_file END AS scan_file,
           CASE WHEN cover_file IN (SELECT file FROM files) THEN cover_file END AS cover_file
    FROM docs"""
)
def linked_null_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir).drop("lang")
    return linked.null_dangling(documents, _files(spark, sf_dir), ["scan_file", "cover_file"])
