"""Delimited text: header CSV scans and the repair of quoted, multi-line records."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from stayscope.functions import values
from stayscope.operators.ordered import with_position
from stayscope.storage import materialise

# Fixed value: the pattern that names a table after its path.
_TABLE_NAME = r"(\w+)(\.csv)?$"


def table_name_from_path(path: Column) -> Column:
    """The last word of a path, without ``.csv``; the path itself if it ends otherwise."""
    name = F.regexp_extract(path, _TABLE_NAME, 1)
    return F.when(name == "", path).otherwise(name)


def _inferred_name(path: str) -> str:
    """:func:`table_name_from_path` of one known path."""
    found = re.search(_TABLE_NAME, path, re.ASCII)
    return found[1] if found else path


def read_csv_table(
    spark: SparkSession,
    path: str,
    view: str | None = None,
    schema: T.StructType | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Header CSV with every column a string, registered as a temp view.

    ``view=None`` names the view after the path. Without ``schema`` the columns are those of
    the first header, all strings; a file whose header differs, in order too, is an error. ``multiline=True`` lets quoted fields span lines, at the price of one task
    per file; :func:`join_quoted_lines` keeps large files splittable.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if multiline:
        reader = reader.option("multiLine", True)
    if schema is None:
        names = reader.csv(path).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    table = reader.schema(schema).option("enforceSchema", False).csv(path)
    table.createOrReplaceTempView(view or _inferred_name(path))
    return table


def clean_quoted_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Row-file repair for single-line records: no doubled quotes, no quoted commas."""
    line = F.replace(F.col(line_col), F.lit('""'), F.lit(" "))
    return lines.withColumn(line_col, values.no_quoted_commas(line))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files with the file and split they came from.

    ``row`` grows along a split; it orders lines only within the same split.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``(line_no, line)`` over all files of :func:`read_lines`, in name and line order."""
    return with_position(lines, ["file", "split", "row"], "line_no").select("line_no", "line")


# A quote closes a field only before a comma or the end of the line, and opens one only after either
# the start of the line or a comma; any other quote is part of the text.
_ENDS = r" *(?:,|\r?$)"
_TO_CLOSING = rf'[^"]*+(?:"(?!{_ENDS})[^"]*+)*+"(?={_ENDS})'
_QUOTED_FIELD = rf'(^|,) *"{_TO_CLOSING}'
_OPENING = r'(?:^|,) *"'
_INNER_QUOTE = _OPENING + r'[^"]*+"'
_FIELD = rf'(?:^|,)(?: *"{_TO_CLOSING} *|[^,]*+)'

#: A record of more lines or characters than this is set apart, with the lines it has swallowed put back.
MAX_RECORD_LINES, MAX_RECORD_CHARS = 10_000, 16_000_000
#: So many lines of a record, all of them whole records by themselves, show that a quote was stray.
MIN_SWALLOWED = 8

_PLACE = ["file", "split", "row"]


def _line_effects(lines: DataFrame, fields: int | None) -> DataFrame:
    """What each line does to the quotes: the state after it if it starts a record, or continues one.

    ``from_out`` and ``from_in`` are 1 where a quoted field stays open, ``inner_out`` and ``inner_in`` true where
    such a field holds a quote that does not end it. ``whole`` says that the line, read by itself, is a
    record of ``fields`` fields without a stray quote.
    """
    line = F.col("line")

    def without_quoted(text: Column) -> Column:
        return F.regexp_replace(text, _QUOTED_FIELD, "$1")

    def is_open(text: Column) -> Column:
        return without_quoted(text).rlike(_OPENING).cast("int")

    closes = line.rlike("^" + _TO_CLOSING)
    after = F.regexp_replace(line, "^" + _TO_CLOSING, "")
    bare = F.when(F.col("quotes") == 0, line).otherwise(without_quoted(line))
    whole = ~bare.contains('"') & (_fields(bare) == (fields or -1))
    return lines.withColumn("quotes", values.count_quotes(line)).select(
        *_PLACE,
        "line",
        F.when(F.col("quotes") == 0, 0).otherwise(is_open(line)).alias("from_out"),
        F.when((F.col("quotes") == 0) | ~closes, 1).otherwise(is_open(after)).alias("from_in"),
        bare.rlike(_INNER_QUOTE).alias("inner_out"),
        (line.rlike(rf'^[^"]*+"(?!{_ENDS})') | (closes & without_quoted(after).rlike(_INNER_QUOTE))).alias("inner_in"),
        (F.col("quotes") % 2).alias("odd"),
        whole.alias("whole"),
        F.length(line).alias("chars"),
    )


def _state_before(out: Column, within: Column, by: list[str], order: str) -> dict[int, Column]:
    """State before each row, for either state at the start of its group.

    The rows' functions on the two states are composed by two running values: the last constant
    function, and how often the state has been flipped since.
    """
    window = Window.partitionBy(*by).orderBy(order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    so_far = window.rowsBetween(Window.unboundedPreceding, 0)
    flip = (out > within).cast("int")
    known = F.when(out == within, (out + F.sum(flip).over(so_far)) % 2)
    last, flips = F.last(known, ignorenulls=True).over(before), F.coalesce(F.sum(flip).over(before), F.lit(0))
    return {entered: (F.coalesce(last, F.lit(entered)) + flips) % 2 for entered in (0, 1)}


def _number_records(effects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(numbered, splits)``: each line's record, and whether it starts with a stray quote.

    Lines are composed within their split first, for either state at its start; one small row
    per split then tells which of the two holds.
    """
    before = _state_before(F.col("from_out"), F.col("from_in"), ["file", "split"], "row")
    local = effects.select(*effects.columns, *[b.alias(f"before{e}") for e, b in before.items()])
    so_far = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    local = local.select(
        "*",
        *[F.sum(1 - F.col(f"before{e}")).over(so_far).alias(f"starts{e}") for e in (0, 1)],
        *[F.expr(f"IF(before{e} = 0, from_out, from_in)").alias(f"after{e}") for e in (0, 1)],
    )
    local = materialise(local, "quoted-local")
    last = F.max(F.struct("row", "after0", "after1"))
    splits = local.groupBy("file", "split").agg(
        F.sum("odd").alias("odd"), last.alias("last"), *[F.max(f"starts{e}").alias(f"starts{e}") for e in (0, 1)]
    )
    splits = materialise(
        splits.select("file", "split", "odd", "last.after0", "last.after1", "starts0", "starts1"), "quoted-splits"
    )
    entered = _state_before(F.col("after0"), F.col("after1"), ["file"], "split")[0]
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("entered", entered).withColumn("n", F.expr("IF(entered = 0, starts0, starts1)"))
    offsets = starts.select("file", "split", "entered", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))

    def chosen(name: str) -> Column:
        return F.expr(f"IF(entered = 0, {name}0, {name}1)")

    numbered = local.join(offsets, ["file", "split"]).select(
        *_PLACE,
        (F.col("offset") + chosen("starts")).alias("record_no"),
        (F.col("stray") & (chosen("before") == 0)).alias("stray"),
    )
    return numbered, splits


_RUNNING = ["n", "chars_so_far", "inner_so_far", "whole_so_far"]


def _mark_stray(effects: DataFrame, max_lines: int, max_chars: int) -> DataFrame:
    """``effects`` with ``stray`` set, and ``from_out`` 0, on lines that open a field which cannot be one.

    Such a field never closes; or its record exceeds the limits; or it holds a quote inside (those of
    the text are doubled, and blank by now); or the line that closes it has an even number of quotes (one
    more than its own quoted fields need would be odd); or it has swallowed many lines that are whole
    records by themselves. What a quote would open depends on the lines after it alone, so all lines are
    judged at once: by running sums up to the next line that closes a field, in the same
    split or, through one small row per split, in a later one.
    """
    by_split = Window.partitionBy("file", "split")
    so_far = by_split.orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    sums = {
        "n": F.count("*"),
        "chars_so_far": F.sum("chars"),
        "inner_so_far": F.sum(F.col("inner_in").cast("int")),
        "whole_so_far": F.sum(F.col("whole").cast("int")),
    }
    local = effects.select("*", *[x.over(so_far).cast("long").alias(c) for c, x in sums.items()])
    place = F.struct(*_RUNNING, "odd", F.col("whole").cast("int").alias("whole"))
    closing = F.when(F.col("from_in") == 0, place)
    later = by_split.orderBy(F.desc("row")).rowsBetween(Window.unboundedPreceding, -1)
    local = materialise(local.withColumn("closed", F.last(closing, ignorenulls=True).over(later)), "quoted-candidates")
    splits = local.groupBy("file", "split").agg(
        F.min(F.when(F.col("from_in") == 0, F.struct("row", place.alias("closing")))).alias("first"),
        *[F.max(c).alias(c) for c in _RUNNING],
    )
    in_file = Window.partitionBy("file")
    earlier = in_file.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    after = in_file.orderBy(F.desc("split")).rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.select(
        "file", "split", "first", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_0") for c in _RUNNING]
    )

    def moved(closing: Column) -> Column:
        moved_sums = [(closing[c] + F.col(f"{c}_0")).alias(c) for c in _RUNNING]
        return F.when(closing.isNotNull(), F.struct(*moved_sums, closing["odd"].alias("odd"), closing["whole"].alias("whole")))

    placed = placed.withColumn("next", F.last(moved(F.col("first.closing")), ignorenulls=True).over(after)).drop("first")
    judged = local.join(placed, ["file", "split"])
    judged = judged.withColumn("end", F.coalesce(moved(F.col("closed")), "next"))

    def between(c: str) -> Column:
        return F.col("end")[c] - F.col(c) - F.col(f"{c}_0")

    swallowed = between("whole_so_far") - F.col("end.whole") == between("n") - 1
    wrong = (
        F.col("end").isNull()
        | F.col("inner_out")
        | (between("inner_so_far") > 0)
        | (F.col("end.odd") == 0)
        | (between("n") + 1 > max_lines)
        | (between("chars_so_far") + F.col("chars") > max_chars)
        | ((between("n") > MIN_SWALLOWED) & swallowed)
    )
    marked = judged.withColumn("stray", (F.col("from_out") == 1) & wrong)
    marked = marked.withColumn("from_out", F.when(F.col("stray"), 0).otherwise(F.col("from_out")))
    return marked.select(*_PLACE, "from_out", "from_in", "odd", "stray")


def join_quoted_lines(
    lines: DataFrame,
    fields: int | None = None,
    odd_quotes: str = "error",
    max_lines: int = MAX_RECORD_LINES,
    max_chars: int = MAX_RECORD_CHARS,
) -> DataFrame:
    """Rebuild records whose quoted fields span lines, keeping file splits parallel.

    Returns ``file, record_no, record, stray``. A line belongs to the record before it when a quoted field
    is open at its start. That state is a running composition of what each line does to it, so
    splits are read independently and joined by one small row each.

    A quote that opens a field by mistake would swallow the lines up to the next closing one. Such quotes
    are recognised (see :func:`_mark_stray`): their line becomes a record of its own with
    ``stray`` set, and the next line starts a record. None of this touches files whose quotes are
    well formed, but for a record over the limits, or one of which at least eight inner lines, and all
    of them, are whole records of ``fields`` fields by themselves.

    A file with an odd number of quotes is an error that names it; ``odd_quotes="reject"`` treats it like others.
    """
    return _joined(*_placed_lines(lines, fields, odd_quotes, max_lines, max_chars))


def _placed_lines(
    lines: DataFrame,
    fields: int | None,
    odd_quotes: str = "error",
    max_lines: int = MAX_RECORD_LINES,
    max_chars: int = MAX_RECORD_CHARS,
) -> tuple[DataFrame, DataFrame]:
    """The cleaned lines, and the record of each."""
    if odd_quotes not in ("error", "reject"):
        raise ValueError(f"unknown treatment of odd quotes: {odd_quotes}")
    cleaned = lines.withColumn("line", values.single_spaced(F.col("line"))).filter(F.col("line").rlike(r"\S"))
    base = materialise(_line_effects(cleaned, fields), "quoted-lines")
    numbered, splits = _number_records(_mark_stray(base.drop("line"), max_lines, max_chars))
    if odd_quotes == "error":
        unbalanced = splits.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).where("odd = 1").first()
        if unbalanced is not None:
            raise ValueError(f"odd number of quotes in {unbalanced['file']}")
    return base.select(*_PLACE, "line"), numbered


def _joined(lines: DataFrame, numbered: DataFrame) -> DataFrame:
    """One row per record of ``numbered``, its lines in one."""
    placed = lines.join(numbered, _PLACE)
    joined = placed.groupBy("file", "record_no").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "line"))).alias("parts"),
        F.bool_or("stray").alias("stray"),
    )
    last = F.size("parts") - 1
    pieces = F.transform(
        "parts",
        lambda p, i: F.when(i < last, F.regexp_replace(p["line"], "\r$", "")).otherwise(p["line"]),
    )
    return joined.select("file", "record_no", _without_quoted_commas(F.array_join(pieces, " ")).alias("record"), "stray")


def _without_quoted_commas(record: Column) -> Column:
    """Commas inside quoted fields become semicolons."""
    fields = F.regexp_extract_all(record, F.lit(f"({_FIELD})"), F.lit(1))
    flat = F.transform(
        fields,
        lambda f, i: F.when(
            F.ltrim(F.substring(f, F.when(i > 0, 2).otherwise(1), F.length(f))).startswith('"'),
            F.concat(F.when(i > 0, ",").otherwise(""), values.no_commas(F.substring(f, F.when(i > 0, 2).otherwise(1), F.length(f)))),
        ).otherwise(f),
    )
    return F.when(record.contains('"'), F.array_join(flat, "")).otherwise(record)


def _fields(record: Column) -> Column:
    """Number of fields of a one-line record; commas in quotes are gone by now."""
    return F.length(record) - F.length(F.replace(record, F.lit(","))) + 1


def parse_records(records: DataFrame, columns: list[str], header: bool = True) -> DataFrame:
    """Split one-line records into string columns.

    With ``header``, the first record of each file (``record_no`` 1) is left out, whatever its
    spelling; a data row that equals it stays. Records with another number of fields than ``columns``, and
    those that begin with a stray quote, are left to :func:`rejected_records`. Records of single lines
    (:func:`clean_quoted_lines`) have no column ``stray``: none of them is.
    """
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    row = F.from_csv(F.col("record"), ddl, {"mode": "PERMISSIVE"})
    good = _fields(F.col("record")) == len(columns)
    if "stray" in records.columns:
        good &= ~F.col("stray")
    if header:
        good &= F.col("record_no") > 1
    return records.filter(good).select(row.alias("row")).select("row.*")


def rejected_records(records: DataFrame, columns: list[str]) -> DataFrame:
    """``file, record_no, record, stray`` of the records that :func:`parse_records` leaves out, but headers."""
    wrong = F.col("stray") | (_fields(F.col("record")) != len(columns))
    return records.filter((F.col("record_no") > 1) & wrong)


def read_multiline_table(
    spark: SparkSession,
    path: str,
    view: str | None = None,
    rejects: str | None = None,
    odd_quotes: str = "error",
    **limits: int,
) -> DataFrame:
    """Header CSV whose quoted fields span lines, read split by split and flattened.

    The splittable twin of ``read_csv_table(multiline=True)``: every column a string, one
    line per record after :func:`join_quoted_lines`. Records with a wrong number of fields or a stray quote are in
    the view ``rejects`` (``<view>_rejects`` by default). Files with different headers are an error.
    """
    columns = spark.read.option("header", True).csv(path).columns
    lines, numbered = _placed_lines(read_lines(spark, path), len(columns), odd_quotes, **limits)
    records = _joined(lines, numbered)
    # The few lines of each file's first record go to all tasks, so no other line is shuffled for them.
    first = _joined(lines, F.broadcast(numbered.where("record_no = 1")))
    head = F.lower(F.translate("record", '" \r', "")).alias("head")
    if len(heads := first.select(head).distinct().limit(2).collect()) > 1:
        raise ValueError(f"files of {path} have different headers: {[r['head'] for r in heads]}")
    name = view or _inferred_name(path)
    table = parse_records(records, columns)
    table.createOrReplaceTempView(name)
    rejected_records(records, columns).createOrReplaceTempView(rejects or f"{name}_rejects")
    return table
