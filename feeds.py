"""Measurement files rendered as text by Spark from the driver's tables.

These frames feed the readers exactly as files would (lines with their row
order, or whole documents), so the readers, the alias mapping and the
transform chain run over whole tables. Every row of ``events`` becomes one
log line / CSV line / JSON document; a run (equipment and day) plays one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.sources.tables import read_table

TS_TEXT = "yyyy-MM-dd HH:mm:ss"
TS_TEXT_FULL = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _run_file(suffix: str):
    run = F.dayofmonth("ts").cast("long") * 10 + F.col("user_id") % 10
    return F.concat(F.lit("run_"), run.cast("string"), F.lit(suffix))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, row_block, row_idx, line — one ``KEY=VALUE`` line per event."""
    e = read_table(spark, sf_dir, "events")
    line = F.format_string(
        "[%s] POSITION=pos_%s ACTUAL=%s EXPECTED=50.0 EQUIPMENT=TOOL_%d OPERATOR=%s",
        F.date_format("ts", TS_TEXT), F.col("event_type"), F.col("value").cast("string"),
        F.col("user_id") % 10, F.col("event_type"))
    return e.select(_run_file(".log").alias("path"), F.lit(0).cast("long").alias("row_block"),
                    F.col("event_id").alias("row_idx"), line.alias("line"))


# Fixed value: the alias header used for the CSV rendering.
CSV_HEADER = "Time,Location,Reading,Nominal,Technician,Machine,Direction,UOM"


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, row_block, row_idx, line — a header line per run file (row
    -1) and one data line per event, columns under alias names."""
    e = read_table(spark, sf_dir, "events")
    data = e.select(
        _run_file(".csv").alias("path"), F.lit(0).cast("long").alias("row_block"),
        F.col("event_id").alias("row_idx"),
        F.concat_ws(",", F.date_format("ts", TS_TEXT_FULL), F.concat(F.lit("pos_"), "event_type"),
                    F.col("value").cast("string"), F.lit("50.0"), F.col("event_type"),
                    F.concat(F.lit("TOOL_"), (F.col("user_id") % 10).cast("string")),
                    F.lit("X"), F.lit("mm")).alias("line"))
    heads = (data.select("path").distinct()
                 .select("path", F.lit(0).cast("long").alias("row_block"), F.lit(-1).cast("long").alias("row_idx"),
                         F.lit(CSV_HEADER).alias("line")))
    return heads.unionByName(data)


def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, doc — one JSON document per event, records under ``records``,
    with a nested object and top-level metadata that is dropped."""
    e = read_table(spark, sf_dir, "events")
    rec = F.struct(
        F.date_format("ts", TS_TEXT_FULL).alias("ts"), F.concat(F.lit("pos_"), "event_type").alias("site"),
        F.col("value").alias("value"), F.lit(50.0).alias("ref"), F.col("event_type").alias("user"),
        F.concat(F.lit("TOOL_"), (F.col("user_id") % 10).cast("string")).alias("tool"),
        F.struct(F.get_json_object("props", "$.k").cast("long").alias("k")).alias("Meta Data"))
    doc = F.to_json(F.struct(F.lit("events").alias("source"), F.array(rec).alias("records")))
    return e.select(F.concat(F.lit("ev_"), F.col("event_id").cast("string"), F.lit(".json")).alias("path"),
                    doc.alias("doc"))


def csv_lines_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``csv_lines``, but readings below 1.0 are left blank (a missing
    value in the file), so the missing-value strategies have work to do."""
    e = read_table(spark, sf_dir, "events")
    reading = F.when(F.col("value") < 1.0, F.lit("")).otherwise(F.col("value").cast("string"))
    data = e.select(
        _run_file(".csv").alias("path"), F.lit(0).cast("long").alias("row_block"),
        F.col("event_id").alias("row_idx"),
        F.concat_ws(",", F.date_format("ts", TS_TEXT_FULL), F.concat(F.lit("pos_"), "event_type"),
                    reading, F.lit("50.0"), F.col("event_type"),
                    F.concat(F.lit("TOOL_"), (F.col("user_id") % 10).cast("string")),
                    F.lit("X"), F.lit("mm")).alias("line"))
    heads = (data.select("path").distinct()
                 .select("path", F.lit(0).cast("long").alias("row_block"), F.lit(-1).cast("long").alias("row_idx"),
                         F.lit(CSV_HEADER).alias("line")))
    return heads.unionByName(data)


def log_lines_without_equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines that carry no equipment key (the run metadata default applies)."""
    e = read_table(spark, sf_dir, "events")
    line = F.format_string("%s pos=%s reading=%s nominal=50.0 tech=%s",
                           F.date_format("ts", "dd/MM/yyyy HH:mm:ss"), F.col("event_type"),
                           F.col("value").cast("string"), F.col("event_type"))
    return e.select(_run_file(".txt").alias("path"), F.lit(0).cast("long").alias("row_block"),
                    F.col("event_id").alias("row_idx"), line.alias("line"))


def _note():
    """A note by event id: comma, quotes, a line break, a stray quote, text after quotes, nothing, plain."""
    k, i = F.col("event_id") % 7, F.col("event_id").cast("string")
    forms = [('"at ', ', late"'), ('"the ""', '"" one"'), ('"first\n', '"'), ('tube 5" ', ""), ('"no" ', ""), None,
             ("note ", "")]
    out = F.lit("")
    for n, f in enumerate(forms):
        if f:
            out = F.when(k == n, F.concat(F.lit(f[0]), i, F.lit(f[1]))).otherwise(out)
    return out


#: Lines of a split of the quoted feed: odd, so that splits begin inside records too.
QUOTED_SPLIT = 4999


def csv_lines_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, row_block, row_idx, line - as ``csv_lines`` with a note that is
    quoted in every way; one event in seven runs over two lines, and every
    ``QUOTED_SPLIT`` lines a new split begins."""
    e = read_table(spark, sf_dir, "events")
    record = F.concat_ws(",", F.date_format("ts", TS_TEXT_FULL), F.concat(F.lit("pos_"), "event_type"),
                         F.col("value").cast("string"), F.lit("50.0"), _note())
    data = e.select(_run_file(".csv").alias("path"), (F.col("event_id") * 2).alias("at"),
                    F.posexplode(F.split(record, "\n")).alias("k", "line"))
    data = data.select("path", (F.col("at") + F.col("k")).alias("row_idx"), "line")
    heads = data.select("path").distinct().select(
        "path", F.lit(-1).cast("long").alias("row_idx"), F.lit("Time,Location,Reading,Nominal,Note").alias("line"))
    return heads.unionByName(data).select(
        "path", F.floor(F.col("row_idx") / QUOTED_SPLIT).alias("row_block"), "row_idx", "line")


# Which columns the files of a run write, by run id.
SHORT_HEADERS = ["Time,Location,Reading,Nominal", "Time,Reading,Nominal", "Time,Location", "Location,Reading", "Comment"]


def csv_lines_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, row_block, row_idx, line - files that lack columns, by run id."""
    run = F.dayofmonth("ts").cast("long") * 10 + F.col("user_id") % 10
    cell = {"Time": F.date_format("ts", TS_TEXT_FULL), "Location": F.concat(F.lit("pos_"), "event_type"),
            "Reading": F.col("value").cast("string"), "Nominal": F.lit("50.0"), "Comment": F.lit("ok")}
    head, line = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, names in enumerate(SHORT_HEADERS):
        mine = run % len(SHORT_HEADERS) == k
        head = F.when(mine, F.lit(names)).otherwise(head)
        line = F.when(mine, F.concat_ws(",", *[cell[c] for c in names.split(",")])).otherwise(line)
    data = read_table(spark, sf_dir, "events").select(
        _run_file(".csv").alias("path"), F.lit(0).cast("long").alias("row_block"), F.col("event_id").alias("row_idx"),
        line.alias("line"), head.alias("head"))
    heads = data.groupBy("path").agg(F.first("head").alias("line")).select(
        "path", F.lit(0).cast("long").alias("row_block"), F.lit(-1).cast("long").alias("row_idx"), "line")
    return heads.unionByName(data.drop("head"))


# Headers by run id; the first two name a column twice once they are cleaned, the third one a column
# that is not mapped.
CLASHING_HEADERS = ["Time,Location, location,Reading,Nominal", "Time,Location,Reading,READING,nominal,Nominal",
                    "Time,Location,Reading,Nominal,Note, note", "Time,Location,Reading,Nominal"]


def csv_lines_clashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, row_block, row_idx, line - files some of whose headers name a column twice, by run id."""
    run = F.dayofmonth("ts").cast("long") * 10 + F.col("user_id") % 10
    cell = {"time": F.date_format("ts", TS_TEXT_FULL), "location": F.concat(F.lit("pos_"), "event_type"),
            "reading": F.col("value").cast("string"), "nominal": F.lit("50.0"), "note": F.lit("ok")}
    head, line = F.lit(None).cast("string"), F.lit(None).cast("string")
    for k, names in enumerate(CLASHING_HEADERS):
        mine = run % len(CLASHING_HEADERS) == k
        head = F.when(mine, F.lit(names)).otherwise(head)
        line = F.when(mine, F.concat_ws(",", *[cell[c.strip().lower()] for c in names.split(",")])).otherwise(line)
    data = read_table(spark, sf_dir, "events").select(
        _run_file(".csv").alias("path"), F.lit(0).cast("long").alias("row_block"), F.col("event_id").alias("row_idx"),
        line.alias("line"), head.alias("head"))
    heads = data.groupBy("path").agg(F.first("head").alias("line")).select(
        "path", F.lit(0).cast("long").alias("row_block"), F.lit(-1).cast("long").alias("row_idx"), "line")
    return heads.unionByName(data.drop("head"))


def csv_lines_with_empty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``csv_lines``, but one event in eleven writes a row of commas alone."""
    empty = F.lit("," * CSV_HEADER.count(","))
    return csv_lines(spark, sf_dir).withColumn(
        "line", F.when((F.col("row_idx") >= 0) & (F.col("row_idx") % 11 == 0), empty).otherwise(F.col("line")))
