"""CSV records over line breaks: which lines belong to one record.

A line moves a reader that is outside (0) or inside (1) a quoted field to
one of the two states, so every line is a function of {0, 1}: it keeps the
state, swaps it, or sets it. A quote opens a field only at the field's start;
anywhere else in an unquoted field it is a character; in a quoted one two
quotes are a character and one ends the quoting.

Lines without quotes keep the state. The functions compose: a window over a
*split* (a byte range of a file, so bounded by the split size) gives each
line's state for a split that starts at 0 or at 1, one row a split gives the
split's own function, and a prefix scan over a file's splits, in order, gives
the state each split starts in. No file is ever in one task, and only the
lines of one record come together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# One whole field (possessive, so that long lines need no stack),
# and lines that end outside quotes when they start outside, or inside, of them.
FIELD = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+'
CLOSED = rf"\A(?:{FIELD},)*+{FIELD}\z"
CLOSED_INSIDE = rf'\A(?:[^"]++|"")*+"[^,]*+(?:,(?:{FIELD},)*+{FIELD})?+\z'
# A field with the comma before it: quoted or not.
COMMA_FIELD = r',("(?:[^"]++|"")*+"[^,]*+|[^,]*+)'


def has_quote(line: str = "line") -> Column:
    return F.contains(F.col(line), F.lit('"'))


def leaves_open(line: str = "line") -> Column:
    """The line, read from outside, ends inside a quoted field."""
    return has_quote(line) & ~F.col(line).rlike(CLOSED)


def field_count(line: str = "line") -> Column:
    """Fields of a whole record without the empty ones at its end."""
    flat = F.concat(F.lit(","), F.col(line))
    flat = F.when(has_quote(line), F.regexp_replace(flat, ',"(?:[^"]++|"")*+"', ",x")).otherwise(flat)
    flat = F.rtrim(flat, F.lit(","))
    return F.length(flat) - F.length(F.replace(flat, F.lit(","), F.lit("")))


def _unquote(field: Column) -> Column:
    body = F.regexp_extract(field, r'(?s)\A"((?:[^"]++|"")*+)"', 1)
    rest = F.regexp_extract(field, r'(?s)\A"(?:[^"]++|"")*+"(.*)\z', 1)
    return F.when(field.startswith('"'), F.concat(F.replace(body, F.lit('""'), F.lit('"')), rest)).otherwise(field)


def fields(line: str = "line") -> Column:
    """The field texts of a whole record."""
    quoted = F.transform(F.regexp_extract_all(F.concat(F.lit(","), F.col(line)), F.lit(COMMA_FIELD), 1), _unquote)
    return F.when(has_quote(line), quoted).otherwise(F.split(F.col(line), ",", -1))


def whole_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, unclosed): lines of files with line breaks in quotes as records, and the paths that end inside quotes.

    ``lines``: path, row_block, row_idx, line. A record has the place of its
    first line; its lines are joined by a line break. Unclosed files have no records.
    """
    ends0 = F.when(has_quote(), (~F.col("line").rlike(CLOSED)).cast("int")).otherwise(F.lit(0))
    ends1 = F.when(has_quote(), (~F.col("line").rlike(CLOSED_INSIDE)).cast("int")).otherwise(F.lit(1))
    # A line sets the state (same end from both), or else keeps or swaps it.
    d = lines.select("path", "row_block", "row_idx", "line", ends0.alias("e0"), ends1.alias("e1")).select(
        "path", "row_block", "row_idx", "line", F.when(F.col("e0") == F.col("e1"), F.col("e0")).alias("set"),
        F.when((F.col("e0") == 1) & (F.col("e1") == 0), 1).otherwise(0).alias("swap"))
    by = Window.partitionBy("path", "row_block").orderBy("row_idx")
    upto, before = (by.rowsBetween(Window.unboundedPreceding, k) for k in (Window.currentRow, -1))
    d = d.withColumn("swaps", F.sum("swap").over(upto))
    # What was set last, as if there had been no swaps before it.
    d = d.withColumn("base", (F.col("set") + F.col("swaps")) % 2)
    d = d.withColumn("last_base", F.last("base", ignorenulls=True).over(before))
    state = lambda start: (F.coalesce("last_base", start) + F.col("swaps") - F.col("swap")) % 2

    splits = d.groupBy("path", "row_block").agg(
        F.max_by("base", F.when(F.col("base").isNotNull(), F.col("row_idx"))).alias("base"),
        (F.sum("swap") % 2).alias("odd"),
        *[F.max(F.when(state(F.lit(k)) == 0, F.col("row_idx"))).alias(f"rec{k}") for k in (0, 1)])
    of = Window.partitionBy("path").orderBy("row_block")  # one row a split of the file
    so_far, earlier = (of.rowsBetween(Window.unboundedPreceding, k) for k in (Window.currentRow, -1))
    splits = splits.withColumn("set", (F.col("base") + F.col("odd")) % 2)
    splits = splits.withColumn("swap", F.when(F.col("set").isNull(), F.col("odd")).otherwise(0))
    splits = splits.withColumn("swaps", F.sum("swap").over(so_far))
    splits = splits.withColumn("base", (F.col("set") + F.col("swaps")) % 2)
    splits = splits.withColumn("start", (F.coalesce(F.last("base", ignorenulls=True).over(earlier), F.lit(0))
                                         + F.col("swaps") - F.col("swap")) % 2)
    splits = splits.withColumn("end", (F.coalesce(F.last("base", ignorenulls=True).over(so_far), F.lit(0))
                                       + F.col("swaps")) % 2)
    rec = F.when(F.col("start") == 0, F.col("rec0")).otherwise(F.col("rec1"))
    # The record that runs into a split began in an earlier one.
    splits = splits.withColumn("carried", F.last(
        F.when(rec.isNotNull(), F.struct("row_block", rec.alias("row_idx"))), ignorenulls=True).over(earlier))
    splits = splits.select("path", "row_block", "start", "end", "carried")
    unclosed = (splits.groupBy("path").agg(F.max_by("end", "row_block").alias("end")).filter(F.col("end") == 1)
                .select("path"))
    d = d.join(splits.join(unclosed, "path", "left_anti"), ["path", "row_block"])
    begins = F.when(state(F.col("start")) == 0, F.struct("row_block", "row_idx"))
    d = d.withColumn("rec", F.coalesce(F.last(begins, ignorenulls=True).over(upto), F.col("carried")))
    joined = d.groupBy("path", "rec").agg(F.array_sort(F.collect_list(F.struct("row_block", "row_idx", "line"))).alias("ls"))
    records = joined.select("path", "rec.row_block", "rec.row_idx",
                            F.array_join(F.transform("ls", lambda x: x["line"]), "\n").alias("line"))
    return records, unclosed
