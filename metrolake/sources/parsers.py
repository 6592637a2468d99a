"""Format readers: CSV (S1), workbook (S2), JSON (S3), key=value logs.

Every reader yields a ``RawBatch``:

* ``rows``:   path, row_block, row_idx, fields map<string,string>
* ``files``:  path, raw_cols array<string> (the file's cleaned column names)
* ``errors``: path, message (files that can not be read as their format)

Line formats are read with ``spark.read.text`` so a large file is split
across tasks. File row order is (``row_block`` = the split's byte offset,
``row_idx`` = monotonically increasing id attached right after the scan),
which is increasing in line order within a file and needs no shuffle.
Whole-document formats (JSON, xlsx) are one document per file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JSON_RECORD_KEYS
from ..functions.columns import null_if_token, strip
from ..functions.maps import fit_to, last_wins_policy, map_last_wins
from ..operators.transforms import clean_keys
from ..session import ensure_checkpoint_dir
from .csv_records import field_count, fields, leaves_open, whole_records
from .files import literal_path, plain_path

#: Header rows (one a file) up to this many are broadcast.
MAX_BROADCAST_FILES = 50_000
#: Columns of the widest header up to which each has its own expression.
MAX_EXPRESSIONS = 100
RAW_ROW_SCHEMA = "path string, row_block long, row_idx long, fields map<string,string>"


@dataclass
class RawBatch:
    rows: DataFrame
    files: DataFrame
    errors: DataFrame

    def union(self, other: "RawBatch") -> "RawBatch":
        return RawBatch(self.rows.unionByName(other.rows), self.files.unionByName(other.files),
                        self.errors.unionByName(other.errors))


def empty_batch(spark: SparkSession) -> RawBatch:
    return RawBatch(spark.createDataFrame([], RAW_ROW_SCHEMA),
                    spark.createDataFrame([], "path string, raw_cols array<string>"),
                    spark.createDataFrame([], "path string, message string"))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, row_block, row_idx, line — ids attached directly after the scan."""
    return spark.read.text([literal_path(p) for p in paths]).select(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("row_block"),
        F.monotonically_increasing_id().alias("row_idx"),
        F.col("value").alias("line"))


def _keys_per_file(rows: DataFrame) -> DataFrame:
    """Union of field names per file (bounded by the file's column count)."""
    return (rows.select("path", F.explode(F.map_keys("fields")).alias("k")).distinct()
                .groupBy("path").agg(F.array_sort(F.collect_list("k")).alias("raw_cols")))


# ---------------------------------------------------------------------------
# S1 CSV
# ---------------------------------------------------------------------------

def _mangle_duplicates(names: Column) -> Column:
    """Repeated header names get ``.1``, ``.2`` ... (first one unchanged)."""
    def seen(x, i):
        return F.size(F.filter(F.slice(names, 1, i), lambda y: y == x))
    return F.transform(names, lambda x, i: F.when(
        (i == 0) | (seen(x, i) == 0), x).otherwise(F.concat(x, F.lit("."), seen(x, i).cast("string"))))


def _csv_files(lines: DataFrame) -> DataFrame:
    """path, _h (first line that is not blank), _hkey, _most (fields of the widest record), _torn."""
    order = F.struct("row_block", "row_idx")
    return (lines.filter(strip("line") != "").groupBy("path")
            .agg(F.min_by("line", order).alias("_h"), F.min(order).alias("_hkey"),
                 F.max(field_count()).alias("_most"), F.max(leaves_open()).alias("_torn")))


def parse_csv(lines: DataFrame) -> RawBatch:
    """Header = first non-blank line of each file; later lines bind to their
    own file's header by name (files with different layouts mix freely).
    pandas' default null tokens read as null; blank lines are skipped; quotes
    are read as pandas reads them (a quote inside an unquoted field is a
    character, a line break inside quotes belongs to its field). A file with a
    record wider than its header, or one that ends inside quotes, is an error.

    One aggregation gives every file's header, its widest record and whether a
    line of it ends inside quotes; only lines of such files are put together
    (``csv_records``). All other lines are read in one projection with as many
    columns as the widest header has (one number read from the file table).
    """
    spark = lines.sparkSession
    ensure_checkpoint_dir(spark)
    # One row a file; checkpointed, as its numbers steer the plan.
    info = _csv_files(lines).checkpoint()
    torn = info.filter("_torn").select("path")
    unclosed, nb = torn.limit(0), lines
    if info.agg(F.max("_torn")).first()[0]:
        records, unclosed = whole_records(lines.join(torn, "path", "left_semi"))
        nb = lines.join(torn, "path", "left_anti").select("path", "row_block", "row_idx", "line").unionByName(records)
        info = info.filter("not _torn").unionByName(_csv_files(records)).checkpoint()
    nb = nb.filter(strip("line") != "")
    head = (info.select("path", "_hkey", "_most", fields("_h").alias("_raw"))
            .select("path", "_hkey", "_most", _mangle_duplicates(F.col("_raw")).alias("_raw"))
            .select("path", "_hkey", "_most", F.transform("_raw", lambda c: F.regexp_replace(
                F.lower(strip(c)), r"\s+", "_")).alias("_cols")))
    wide = F.col("_most") > F.size("_cols")
    errors = (nb.join(head.filter(wide), "path").filter(field_count() > F.size("_cols"))
              .groupBy("path").agg(F.count(F.lit(1)).alias("_n"))
              .select("path", F.format_string("Error tokenizing data: %d row(s) with more fields than the header",
                                              F.col("_n")).alias("message"))
              .unionByName(unclosed.select("path", F.lit("Error tokenizing data: end of file inside quotes").alias("message"))))
    head = head.filter(~wide)
    files = head.select("path", F.col("_cols").alias("raw_cols"))  # repeats show (``outcomes.transform_errors``)
    got = head.agg(F.max(F.size("_cols")), F.count(F.lit(1))).first()
    width, n_files = int(got[0] or 0), got[1]
    if width == 0:
        return RawBatch(spark.createDataFrame([], RAW_ROW_SCHEMA), files, errors)
    small = head.select("path", "_hkey", "_cols")
    # One header row a file: broadcast up to a counted number of files, else AQE chooses.
    data = (nb.join(F.broadcast(small) if n_files <= MAX_BROADCAST_FILES else small, "path")
              .filter(F.struct("row_block", "row_idx") != F.col("_hkey"))
              .select("path", "row_block", "row_idx", "_cols", fields().alias("_f")))
    # An expression a column is faster than a lambda, as long as the generated code stays small.
    vals = (F.array(*[null_if_token(F.get("_f", F.lit(i))) for i in range(width)]) if width <= MAX_EXPRESSIONS
            else F.transform("_f", null_if_token))
    rows = data.select("path", "row_block", "row_idx",
                       map_last_wins(F.col("_cols"), fit_to(vals, F.size("_cols")), last_wins_policy(spark)).alias("fields"))
    return RawBatch(rows, files, errors)


# ---------------------------------------------------------------------------
# S4 key=value logs
# ---------------------------------------------------------------------------

# Timestamp shapes tried in order, and the key=value pattern.
LOG_TIMESTAMP_PATTERNS = [
    r"\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}",
    r"\d{2}/\d{2}/\d{4}\s+\d{2}:\d{2}:\d{2}",
    r"\d{2}-\w{3}-\d{4}\s+\d{2}:\d{2}:\d{2}",
]
LOG_KV_PATTERN = r"(\w+)\s*=\s*([^\s,;|]+)"


def parse_log(lines: DataFrame) -> RawBatch:
    """Blank and ``#`` lines are skipped; a line becomes a record of its
    first timestamp-looking text (under ``timestamp``) and all its
    ``key=value`` pairs (keys lower-cased, last wins, an explicit
    ``timestamp=`` beats the found one); records with fewer than two fields
    are dropped. A file without records is an error."""
    spark = lines.sparkSession
    # Lines and records are chosen by ``explode``: a filter would be pushed below the projections and run all that
    # makes a line, and every pattern, there again.
    t = F.col("line")
    kept = lines.select("path", "row_block", "row_idx", strip("line").alias("line")).select(
        "path", "row_block", "row_idx", F.explode(F.when((t != "") & ~t.startswith("#"), F.array(t))).alias("line"))
    # First shape that occurs: coalesce stops at the first match, so each
    # pattern runs at most once per line.
    ts = F.coalesce(*[F.nullif(F.regexp_extract("line", "(?U)" + pat, 0), F.lit(""))
                      for pat in LOG_TIMESTAMP_PATTERNS])
    # Staged projections: each extracted array is computed once, then referenced.
    # Keys come from the lower-cased line (lower-casing keeps the match
    # structure), values from the line itself: no per-element lambda.
    staged = kept.select(
        "path", "row_block", "row_idx", ts.alias("_ts"),
        F.regexp_extract_all(F.lower("line"), F.lit("(?U)" + LOG_KV_PATTERN), 1).alias("_k"),
        F.regexp_extract_all("line", F.lit("(?U)" + LOG_KV_PATTERN), 2).alias("_v"))
    staged = staged.select("path", "row_block", "row_idx", "_ts",
                           map_last_wins(F.col("_k"), F.col("_v"), last_wins_policy(spark)).alias("_kv"))
    ts_map = F.when(F.col("_ts").isNotNull() & ~F.array_contains(F.map_keys("_kv"), F.lit("timestamp")),
                    F.create_map(F.lit("timestamp"), F.col("_ts"))).otherwise(
        F.create_map().cast("map<string,string>"))
    staged = staged.select("path", "row_block", "row_idx", F.map_concat(ts_map, F.col("_kv")).alias("fields"))
    rows = staged.select("path", "row_block", "row_idx", F.explode(
        F.when(F.size("fields") >= 2, F.array("fields"))).alias("fields"))
    files = _keys_per_file(rows)
    listed = lines.select("path").distinct()
    errors = (listed.join(files.select("path"), "path", "left_anti")
                    .select("path", F.concat(F.lit("No parseable records found in "), F.col("path")).alias("message")))
    return RawBatch(rows, files, errors)


# ---------------------------------------------------------------------------
# S3 JSON
# ---------------------------------------------------------------------------

def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, doc — one whole document per file."""
    return spark.read.text([literal_path(p) for p in paths], wholetext=True).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("doc"))


def _is_object(v: Column) -> Column:
    """Text of a JSON object: it starts like one and parses as one (the text ``{A1}`` does not)."""
    return strip(v).startswith("{") & F.from_json(v, "map<string,string>").isNotNull()


def _flatten_once(m: Column) -> Column:
    """One level of nested JSON objects (kept as text values) -> ``a.b`` keys."""
    leaves = F.map_filter(m, lambda k, v: v.isNull() | ~_is_object(v))
    nested = F.map_filter(m, lambda k, v: v.isNotNull() & _is_object(v))
    expanded = F.aggregate(
        F.map_entries(nested), F.create_map().cast("map<string,string>"),
        lambda acc, e: F.map_concat(acc, F.transform_keys(
            F.from_json(e["value"], "map<string,string>"), lambda k, v: F.concat(e["key"], F.lit("."), k))))
    return F.map_concat(leaves, expanded)


def _nesting(docs: DataFrame) -> int:
    """Most objects inside each other in any document: one pass over the braces outside of strings."""
    braces = F.regexp_replace(F.regexp_replace("doc", r'"(?:[^"\\]|\\.)*+"', ""), r"[^{}]", "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, c: Column) -> Column:
        now = acc["now"] + F.when(c == "{", 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))
    deep = F.aggregate(F.filter(F.split(braces, ""), lambda c: c != ""), zero, step)["most"]
    return docs.agg(F.max(deep)).first()[0] or 0


def parse_json(docs: DataFrame) -> RawBatch:
    """A list of objects; or an object whose first key among
    data / measurements / records / results holds a list; else the object
    is one record. Nested objects of any depth flatten to ``a.b`` (then dots
    and blanks become ``_``); inner lists stay as JSON text; top-level metadata
    next to the record list is dropped. A list with an element that is no
    object makes its file an error. Each step is its own projection so that the
    parsed values are referenced, not re-parsed."""
    d = docs.select("path", strip("doc").alias("doc"))
    d = d.select("path", "doc", F.from_json("doc", "map<string,string>").alias("_top"))
    picked = F.lit(None).cast("string")
    for key in reversed(JSON_RECORD_KEYS):
        v = F.element_at(F.col("_top"), F.lit(key))
        picked = F.when(strip(v).startswith("["), v).otherwise(picked)
    # A document that does not parse gives null records (an extract error).
    records = (F.when(F.col("doc").startswith("["), F.from_json("doc", "array<string>"))
                .when(F.col("doc").startswith("{") & F.col("_top").isNotNull(),
                      F.when(picked.isNotNull(), F.from_json(picked, "array<string>"))
                       .otherwise(F.array(F.col("doc")))))
    parsed = d.select("path", records.alias("_recs"))
    whole = ~F.exists("_recs", lambda r: r.isNull() | ~_is_object(r))
    parsed = parsed.select("path", F.when(whole, F.col("_recs")).alias("_recs"))
    ex = (parsed.select("path", F.posexplode_outer("_recs").alias("row_idx", "_rec"))
                .filter(F.col("_rec").isNotNull())
                .select("path", "row_idx", F.from_json("_rec", "map<string,string>").alias("_m"))
                .filter(F.col("_m").isNotNull()))
    for _ in range(max(0, _nesting(d) - 1)):
        ex = ex.select("path", "row_idx", _flatten_once(F.col("_m")).alias("_m"))
    cleaned = clean_keys(F.col("_m"), json_style=True)
    rows = ex.select("path", F.lit(0).cast("long").alias("row_block"), F.col("row_idx").cast("long"),
                     cleaned.alias("fields"))
    files = _keys_per_file(rows)
    errors = (parsed.filter(F.col("_recs").isNull())
                    .select("path", F.concat(F.lit("Invalid JSON document: "), F.col("path")).alias("message")))
    return RawBatch(rows, files, errors)
