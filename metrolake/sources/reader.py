"""Format dispatch over a listing (S5): one RawBatch for all files.

The listing's path strings (file-index metadata, which Spark's own file
index also keeps on the driver) are grouped by format and handed to the
matching reader; no file content passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import parsers
from .files import describe_listing, unsupported_message


def paths_by_format(listing: DataFrame) -> dict[str, list[str]]:
    """Group the listing's paths by format (``None`` = unsupported)."""
    out: dict[str, list[str]] = {}
    for r in describe_listing(listing).select("path", "format").toLocalIterator():
        out.setdefault(r["format"], []).append(r["path"])
    return out


def read_raw(spark: SparkSession, listing: DataFrame,
             groups: dict[str, list[str]] | None = None) -> parsers.RawBatch:
    """Read every listed file with its format's reader.

    Unsupported suffixes become ``errors`` rows (they are extract errors in
    the ingest summary and ledger).
    """
    groups = groups if groups is not None else paths_by_format(listing)
    batch = parsers.empty_batch(spark)
    if groups.get("csv"):
        batch = batch.union(parsers.parse_csv(parsers.read_lines(spark, groups["csv"])))
    if groups.get("log"):
        batch = batch.union(parsers.parse_log(parsers.read_lines(spark, groups["log"])))
    if groups.get("json"):
        batch = batch.union(parsers.parse_json(parsers.read_documents(spark, groups["json"])))
    if groups.get("excel"):
        from .workbook import parse_workbooks  # Python worker path only when needed
        batch = batch.union(parse_workbooks(spark, groups["excel"]))
    bad = groups.get(None) or []
    if bad:
        errs = (spark.createDataFrame([(p,) for p in bad], "path string")
                .select("path", unsupported_message("path").alias("message")))
        batch = parsers.RawBatch(batch.rows, batch.files, batch.errors.unionByName(errs))
    return batch
