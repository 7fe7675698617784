"""Text and JSON drops as typed tables, with malformed rows set aside.

Every field is read as text and converted by an expression. Whether a row is accepted thus depends on
all of its fields and never on which columns a query happens to select, as it would if the reader
converted only the selected ones.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import replace
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidefeed.functions import col
from tidefeed.operators.table import Split, all_of, is_number, missing_number

# File suffixes and what they hold.
SEPARATORS = {"csv": ",", "txt": "\t"}
DATABASE_SUFFIXES = ("sqlite", "db")
JSON_SUFFIX = "json"
JSON_LINES_SUFFIX = "jsonl"

#: Array files up to this size are read by one task each.
WHOLE_ARRAY_BYTES = 64 * 1024 * 1024

_CORRUPT = "_corrupt_record"
_READ = "__read"
_LINE = "__line"
_OPENS_ARRAY = r"^[\s\x{FEFF}]*\["
_EMPTY_ARRAY = _OPENS_ARRAY + r"\s*\]\s*$"


def suffix_of(path: str) -> str:
    """What follows the last dot, case kept; empty where there is no dot."""
    return path.rpartition(".")[2] if "." in path else ""


def any_of(folder: str, names: Sequence[str]) -> str:
    """A path that reads those of the named files that exist, pooled."""
    return f"{folder.rstrip('/')}/{{{','.join(names)}}}"


def load(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    require_rows: bool = False,
    table: str | None = None,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """The well-formed rows of a file, folder or glob whose suffix is csv, txt, json, jsonl, db or sqlite.

    Rows that miss the value of a numeric column are left out, as are malformed ones; ``load_split``
    gives them too. With ``require_rows`` an input without any good row is an error.
    """
    parts = load_split(spark, path, schema, table=table, sampling_ratio=sampling_ratio)
    accepted = parts.accepted
    if require_rows and accepted.isEmpty():
        raise ValueError(f"no valid row in {path}")
    return accepted


def load_split(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    table: str | None = None,
    sampling_ratio: float = 1.0,
) -> Split:
    """As ``load``, with the rows that were set aside: ``(motivo, registro)``.

    Without a schema the types are inferred in a pass of their own, from the given share of the rows.
    """
    from tidefeed.sources.database import read_database

    suffix = suffix_of(path)
    if suffix in SEPARATORS:
        parts = read_delimited(spark, path, SEPARATORS[suffix], schema, sampling_ratio)
    elif suffix in DATABASE_SUFFIXES:
        parts = read_database(spark, path, table=table, schema=schema)
    elif suffix in (JSON_SUFFIX, JSON_LINES_SUFFIX):
        parts = read_json(spark, path, schema, suffix == JSON_LINES_SUFFIX, sampling_ratio)
    else:
        raise ValueError(f"unsupported format: {suffix!r}")
    typed = parts.accepted
    reason = F.coalesce("motivo", missing_number(typed))
    # A number that could not be read is missing too, so one condition covers both faults.
    numbers = [col(f.name).isNotNull() for f in typed.schema if is_number(f)]
    good = all_of([F.col(_READ), *numbers])
    return replace(parts, marked=parts.marked.withColumn("motivo", reason), good=good)


def read_delimited(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    schema: T.StructType | None = None,
    sampling_ratio: float = 1.0,
    *,
    line_safe: bool = False,
    multi_line: bool = False,
) -> Split:
    """Delimited text with a header line; quoted fields may hold the separator.

    Lines with too few or too many fields, and fields that do not fit their column, set a row aside. Each
    file has its own header, and a schema is matched to it by name. Where no file has all of its names, it
    is matched by position; where some have, the lines of the others are set aside, as ``arity`` where they
    have not as many fields as their header and the schema, else as ``header``. A header is never a row.
    All headers are found in one job when the table is declared.

    A line with a quote that is not closed is set aside as ``quote``. With ``multi_line`` a quoted field may
    go on over several lines, see ``whole_records``; breaks in it come out as line feeds. ``line_safe`` is for
    files that ``write_csv`` wrote so.
    """
    options = {"header": True, "sep": separator, "quote": '"', "escape": '"'}
    by_header = _files_by_header(spark, path, separator)
    if schema is None:
        if not by_header:
            raise ValueError(f"no header in {path}")
        schema = _inferred(spark, by_header, {**options, "samplingRatio": sampling_ratio, "multiLine": multi_line})
    fitting = {h: f for h, f in by_header.items() if set(schema.names) <= set(h)}
    foreign = {h: f for h, f in by_header.items() if h not in fitting}
    if not fitting:  # headers that say nothing, or no file with a line
        fitting, foreign = {tuple(schema.names): [path]}, {}
    parts = []
    for header, files in fitting.items():
        mine = _plain(files) if foreign or len(fitting) > 1 else path
        lines = whole_records(_placed(spark.read.text(mine), F.col("value"))) if multi_line else _body_lines(spark, mine)
        raw = _fields(lines, header, options)
        if line_safe:
            raw = raw.withColumns({name: _with_breaks(col(name)) for name in header})
        line = F.col(_LINE)
        reason = F.when(_open_quote(line), F.lit("quote")).otherwise(F.lit("arity"))
        parts.append(_typed(raw, schema, reason, _open_quote(line) | F.col(_CORRUPT).isNotNull(), line))
    if foreign:
        parts.append(_set_aside(spark, foreign, schema, separator))
    marked = reduce(DataFrame.unionByName, [part.marked for part in parts])
    return replace(parts[0], marked=marked)


def _with_breaks(value: Column) -> Column:
    written_empty = value == "\\e"
    for written, plain in (("\\n", "\n"), ("\\r", "\r"), ("\\s", "\\")):
        value = F.replace(value, F.lit(written), F.lit(plain))
    return F.when(written_empty, F.lit("")).otherwise(value)


def first_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file`` and ``line``: the first line of each file that is not blank, in one job for any number of files.

    Each split of a file gives its first line, and of these the one of the first split counts. A task that
    reads a split which ends before its file does has no other split, and stops after that line; so of a large
    file no more than its last split is read.
    """
    at = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start", "file_block_length", "file_size")]
    lines = spark.read.text(path).where(F.trim("value") != "").select(*at, "value")

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            split = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            new = [i for i, s in enumerate(split) if s != (split[i - 1] if i else last)]
            yield batch.take(pa.array(new, pa.int64())).select(["file_path", "file_block_start", "value"])
            if split:
                last = split[-1]
                if last[1] + batch.column(2)[-1].as_py() < batch.column(3)[-1].as_py():
                    return

    found = lines.mapInArrow(firsts, "file_path string, file_block_start long, value string")
    return found.groupBy(F.col("file_path").alias("file")).agg(F.min_by("value", "file_block_start").alias("line"))


def audit_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of delimited text: ``file`` (in URL form), ``bytes``, ``header``, ``rows`` (lines that are neither
    blank nor the header) and ``fault``: ``no header`` where no line is filled, ``no rows`` where only one is."""
    # Readers skip files of no bytes. The list has local paths with an empty authority, the metadata without.
    names = [re.sub("^file:///", "file:/", f) for f in spark.read.text(path).inputFiles()]
    listed = spark.createDataFrame([(f,) for f in names], "file string")
    filled = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"))
    sizes = listed.join(filled, "file", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)).cast("long"))
    rows = _body_lines(spark, path).groupBy("file").agg(F.count("*").alias("rows"))
    headers = first_lines(spark, path).withColumnRenamed("line", "header")
    found = sizes.join(headers, "file", "left").join(rows, "file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))
    fault = F.when(F.col("header").isNull(), "no header").when(F.col("rows") == 0, "no rows")
    return found.withColumn("fault", fault)


def _files_by_header(spark: SparkSession, path: str, separator: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a path, in URL form, by the names in their first lines; files without a line are left out."""
    out: dict[tuple[str, ...], list[str]] = {}
    for file, line in sorted(map(tuple, first_lines(spark, path).collect())):
        out.setdefault(_header_names(line, separator), []).append(file)
    return out


def _plain(files: Sequence[str]) -> list[str]:
    """Paths as a reader takes them; the metadata column has them in URL form."""
    return [unquote(f) for f in files]


def _header_names(line: str, separator: str) -> tuple[str, ...]:
    """The names in a header line, as the CSV reader gives them: without a name ``_c`` and the place, and repeated
    ones with their place added."""
    names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=separator))
    seen = Counter(name.lower() for name in names)
    return tuple(f"_c{i}" if not name else f"{name}{i}" if seen[name.lower()] > 1 else name for i, name in enumerate(names))


def _inferred(spark: SparkSession, by_header: dict[tuple[str, ...], list[str]], options: dict) -> T.StructType:
    """The types of the first header's columns over all files that have these names, in one pass for each order of
    the names."""
    reader = spark.read.options(**options, inferSchema=True)
    names = set(next(iter(by_header)))
    return reduce(_wider, [three_types(reader.csv(_plain(f)).schema) for h, f in by_header.items() if set(h) == names])


def _body_lines(spark: SparkSession, files: str | list[str]) -> DataFrame:
    """``line`` and its place (``file``, ``block``, ``at``) for every line that is neither blank nor its file's header."""
    # One column, with a separator that lines do not have; a line that does have it comes as the corrupt record.
    reader = spark.read.options(header=True, sep="\x01", quote="", escape="", mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, columnPruning=False)
    whole = reader.schema(T.StructType([T.StructField("value", T.StringType()), T.StructField(_CORRUPT, T.StringType())]))
    return _placed(whole.csv(files), F.coalesce(_CORRUPT, "value"))


def _placed(lines: DataFrame, line: Column, *more: Column) -> DataFrame:
    return lines.select(
        *more,
        line.alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _open_quote(line: Column) -> Column:
    return _quotes(line) % 2 == 1


def _fields(lines: DataFrame, header: Sequence[str], options: dict) -> DataFrame:
    """The fields of each ``line`` as text, the line, and it once more as the corrupt record where their number is not the
    header's."""
    wanted = _all_text(T.StructType([T.StructField(name, T.StringType()) for name in header]))
    options = {"sep": options["sep"], "quote": options["quote"], "escape": options["escape"], "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_csv("line", F.lit(wanted.toDDL()), options)
    # The generator keeps conditions on the fields above it, so that a line is parsed once.
    return lines.select(F.col("line").alias(_LINE), F.inline(F.array(parsed)))


def _set_aside(spark: SparkSession, foreign: dict[tuple[str, ...], list[str]], schema: T.StructType, separator: str) -> Split:
    """The lines of files whose header lacks a name of the schema, each with the reason."""
    files = [f for listed in foreign.values() for f in listed]
    own = spark.createDataFrame([(f, len(h)) for h, listed in foreign.items() for f in listed], "file string, own int")
    outside = F.regexp_replace("line", '"[^"]*"', "")
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(separator), F.lit(""))) + 1
    uneven = (fields != len(schema)) | (fields != F.coalesce("own", fields))
    reason = F.when(_open_quote(F.col("line")), "quote").when(uneven, "arity").otherwise("header")
    lines = _body_lines(spark, _plain(files)).join(own, "file", "left")
    typed = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return record_split(lines, typed, reason, F.col("line"), F.lit(False))


def whole_records(lines: DataFrame, most_lines: int = 10_000) -> DataFrame:
    """``line``: records whose quoted fields may hold line breaks, from all lines and their places (``_placed``), without
    each file's header and the blank lines between records.

    A line is inside a field if the lines of its file before it hold an odd number of quotes. These are summed per
    block of the file first, so that no task reads more of a file than a block. Most records are a line and stay
    where they are; only the lines of the others are brought together. Where a field is never closed, or a record
    would have more than ``most_lines`` lines, its lines come out as they are and are then set aside one by one.
    """
    odd = _open_quote(F.col("line")).cast("int")
    so_far = Window.partitionBy("file", "block").orderBy("at")
    before = F.coalesce(F.sum(odd).over(so_far.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    lines = lines.withColumns({"odd": odd, "inside": before})
    begins = {i: F.max(F.when(F.col("inside") == i, F.col("at"))).alias(f"last{i}") for i in (0, 1)}
    filled = F.trim("line") != ""
    header = F.min(F.when(filled, F.struct("block", "at"))).alias("header")
    blocks = lines.groupBy("file", "block").agg((F.sum("odd") % 2).alias("turns"), header, *begins.values())
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("entered", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    last = F.when(F.col("entered") == 0, F.col("last0")).otherwise(F.col("last1"))
    start = F.when(last.isNotNull(), F.struct("block", last.alias("at")))
    blocks = blocks.withColumns(
        {"open": F.last(start, ignorenulls=True).over(earlier), "header": F.min("header").over(Window.partitionBy("file"))}
    )
    placed = lines.join(blocks.select("file", "block", "entered", "open", "header"), ["file", "block"])
    placed = placed.withColumn("inside", (F.col("inside") + F.col("entered")) % 2)
    here = F.when(F.col("inside") == 0, F.struct("block", "at"))
    whole = (F.col("inside") == 0) & (F.col("odd") == 0)
    placed = placed.withColumn("record", F.coalesce(F.last(here, ignorenulls=True).over(so_far), "open"))
    parts = placed.where(~whole).withColumn("n", F.count("*").over(Window.partitionBy("file", "record")))
    parts = parts.withColumn("closes", F.sum("odd").over(Window.partitionBy("file", "record")) == 2)
    fits = F.col("closes") & (F.col("n") <= most_lines)
    joined = parts.where(fits).groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("l"))
    joined = joined.select(F.array_join("l.line", "\n").alias("line"))
    body = F.col("header").isNull() | (F.struct("block", "at") != F.col("header"))
    alone = placed.where(whole & filled & body).select("line")
    return alone.unionAll(joined).unionAll(parts.where(~fits & filled).select("line"))


def _wider(a: T.StructType, b: T.StructType) -> T.StructType:
    """The types of ``a``, widened to hold those of ``b``, which has the same names."""
    order = [T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()]
    held = {f.name: f.dataType for f in b}
    rank = {t: i for i, t in enumerate(order)}
    return T.StructType(
        [T.StructField(f.name, max(f.dataType, held[f.name], key=lambda t: rank.get(t, 3))) for f in a]
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    lines: bool = False,
    sampling_ratio: float = 1.0,
    *,
    whole_bytes: int = WHOLE_ARRAY_BYTES,
) -> Split:
    """Files that each hold one array of objects, or (``lines``) one object per line.

    Array files up to ``whole_bytes`` are read as one text each; one that is no array is set aside as one row. Larger ones,
    of any size, are read by many tasks (``array_objects``) and set aside piece by piece.

    The columns are the keys of the first object, in name order. Nested values and booleans stay JSON
    text. Without a schema the types are inferred by one task per array file.
    """
    if schema is None:
        schema = _json_schema(spark, path, lines, sampling_ratio)
    if not schema:  # no object in any file: what is there is set aside
        left = spark.read.text(path) if lines else _array_files(spark, path)
        left = left.where(F.col("value").rlike(r"\S") & ~F.col("value").rlike(_EMPTY_ARRAY))
        return record_split(left, [], F.lit("json"), F.col("value"), F.lit(False))
    raw = _json_lines(spark, path, schema) if lines else _json_arrays(spark, path, schema, whole_bytes)
    return _typed(raw, schema, "json")


def _json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT)
    return reader.schema(_all_text(schema)).json(path)


def _json_arrays(spark: SparkSession, path: str, schema: T.StructType, whole_bytes: int) -> DataFrame:
    """Objects of array files, their fields as text: of files up to ``whole_bytes`` as one text each, of larger ones by
    tasks that each take a part of a file."""
    sizes = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    if sizes <= whole_bytes:
        return _objects_of_texts(_array_files(spark, path), schema)
    small = _array_files(spark, path).where(F.col("_metadata.file_size") <= whole_bytes)
    return _objects_of_texts(small, schema).unionByName(_objects_of_parts(array_objects(spark, path, whole_bytes), schema))


def _objects_of_texts(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """The objects of arrays, each the text of a file.

    They are parsed as values and not by the multi-line reader, which goes back to the file for
    the text of every single number.
    """
    layout = T.ArrayType(_all_text(schema))
    nothing = [F.lit(None).cast("string").alias(name) for name in schema.names]
    broken = F.array(F.struct(*nothing, F.col("value").alias(_CORRUPT)))
    # A file is to be parsed once, so no condition on the parsed value may be moved below its use: a
    # broken file becomes one object that holds its text, empty arrays are told by their text, and the
    # outer form of the generator keeps the optimizer from adding a check that there are objects.
    listed = F.when(F.col("value").rlike(_OPENS_ARRAY), F.from_json("value", layout))
    objects = F.coalesce(listed, broken).alias("objects")
    filled = texts.where(~F.col("value").rlike(_EMPTY_ARRAY))
    return filled.select(objects).select(F.inline_outer("objects"))


def _objects_of_parts(objects: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of each object of ``array_objects``; what is none comes as the corrupt record."""
    parsed = F.from_json("value", _all_text(schema), {"columnNameOfCorruptRecord": _CORRUPT})
    rows = objects.select("value", "broken", F.inline(F.array(F.when(~F.col("broken"), parsed))))
    return rows.withColumn(_CORRUPT, F.when(F.col("broken"), F.col("value")).otherwise(F.col(_CORRUPT))).drop("value", "broken")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def array_objects(spark: SparkSession, path: str, above: int = 0) -> DataFrame:
    """``value``, ``broken``: the objects of arrays in files of more than ``above`` bytes, each file read by many tasks.

    Files are read as pieces that end in a closing brace, from any place on. Whether a piece begins inside a text depends
    on the quotes before it, and how many objects are open there on the braces outside texts; both are summed per
    block of the file first, for either way that the block may begin, so that no task reads more of a file than a
    block. A piece with no object open at its ends is an object; the pieces of others are brought together.

    A file that is not one array of objects, with commas between them, has its pieces come out as ``broken``.
    """
    pieces = spark.read.option("lineSep", "}").text(path).where(F.col("_metadata.file_size") > above)
    pieces = _placed(pieces, F.col("value"), F.col("_metadata.file_size").alias("size")).withColumnRenamed("line", "text")
    plain = F.regexp_replace("text", r"(?s)\\.", "")
    outside = [F.regexp_replace(x, r'"[^"]*("|\z)', "") for x in (plain, F.concat(F.lit('"'), plain))]
    pieces = pieces.withColumns({"quotes": _count(plain, '"') % 2, "opens0": _count(outside[0], "{"), "opens1": _count(outside[1], "{")})
    so_far = Window.partitionBy("file", "block").orderBy("at")
    above_here = so_far.rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("odd", F.coalesce(F.sum("quotes").over(above_here), F.lit(0)) % 2)

    def change(begun: int) -> Column:
        """How many more objects are open after a piece, if its block begins inside a text or not."""
        inside = (F.col("odd") + begun) % 2
        return F.when(inside == 0, F.col("opens0")).otherwise(F.col("opens1")) - F.when((inside + F.col("quotes")) % 2 == 0, 1).otherwise(0)

    pieces = pieces.withColumns({"change0": change(0), "change1": change(1)})
    before = [F.coalesce(F.sum(f"change{b}").over(above_here), F.lit(0)) for b in (0, 1)]
    pieces = pieces.withColumns({"before0": before[0], "before1": before[1]})
    blocks = pieces.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("turns"), F.sum("change0").alias("sum0"), F.sum("change1").alias("sum1"),
        F.min("at").alias("first"), F.max("at").alias("last"), F.sum(F.octet_length("text") + 1).alias("bytes"),
        F.max("size").alias("size"),
    )
    in_file = Window.partitionBy("file").orderBy("block")
    earlier, all_of_file = in_file.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    blocks = blocks.withColumn("begun", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    total = F.when(F.col("begun") == 0, F.col("sum0")).otherwise(F.col("sum1"))
    blocks = blocks.withColumns(
        {
            "entered": F.coalesce(F.sum(total).over(earlier), F.lit(0)),
            "head": F.min(F.struct("block", F.col("first").alias("at"))).over(all_of_file),
            "tail": F.max(F.struct("block", F.col("last").alias("at"))).over(all_of_file),
            "ended": F.sum("bytes").over(all_of_file) == F.col("size"),  # the last piece, too, by a brace
        }
    )
    pieces = pieces.drop("size").join(blocks.select("file", "block", "begun", "entered", "head", "tail", "ended"), ["file", "block"])
    begun, place = F.col("begun"), F.struct("block", "at")
    depth = F.col("entered") + F.when(begun == 0, F.col("before0")).otherwise(F.col("before1"))
    after = depth + F.when(begun == 0, F.col("change0")).otherwise(F.col("change1"))
    is_head, is_tail = place == F.col("head"), place == F.col("tail")
    lead = F.when(is_head, r"^[\s\x{FEFF}]*\[\s*\{").otherwise(r"^\s*,\s*\{")
    fits = F.when(is_tail & is_head, F.col("text").rlike(_EMPTY_ARRAY)).when(is_tail, F.col("text").rlike(r"^\s*\]\s*\z"))
    fits = fits.otherwise(F.regexp_like("text", lead)) & ((F.col("odd") + begun) % 2 == 0)
    pieces = pieces.withColumns({"depth": depth, "after": after, "is_tail": is_tail})
    pieces = pieces.withColumn("fits", F.when(F.col("depth") == 0, fits).otherwise((F.col("depth") > 0) & ~F.col("is_tail")))
    starts = F.when(F.col("depth") == 0, F.struct("block", "at"))
    summed = pieces.groupBy("file", "block").agg(F.min("fits").alias("fits"), F.max(starts).alias("start"))
    summed = summed.withColumns(
        {"whole": F.min("fits").over(all_of_file), "open": F.last("start", ignorenulls=True).over(earlier)}
    )
    pieces = pieces.drop("fits").join(summed.select("file", "block", "whole", "open"), ["file", "block"])
    broken = pieces.where(~F.col("whole")).select(F.concat("text", F.when(F.col("is_tail") & ~F.col("ended"), "").otherwise("}")).alias("value"))
    pieces = pieces.where(F.col("whole") & ~F.col("is_tail"))
    piece = F.concat(F.when(F.col("depth") == 0, F.regexp_replace("text", r"^[\s\x{FEFF}\[,]*", "")).otherwise(F.col("text")), F.lit("}"))
    alone = (F.col("depth") == 0) & (F.col("after") == 0)
    key = F.coalesce(F.last(starts, ignorenulls=True).over(so_far), "open")
    parts = pieces.withColumns({"object": key, "piece": piece}).where(~alone)
    joined = parts.groupBy("file", "object").agg(F.sort_array(F.collect_list(F.struct("block", "at", "piece"))).alias("p"))
    objects = pieces.where(alone).select(piece.alias("value")).unionAll(joined.select(F.array_join("p.piece", "").alias("value")))
    return objects.withColumn("broken", F.lit(False)).unionAll(broken.withColumn("broken", F.lit(True)))


def _array_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).where(F.col("value").rlike(r"\S"))


def _json_schema(
    spark: SparkSession, path: str, lines: bool, sampling_ratio: float
) -> T.StructType:
    """The keys of the first object, typed by the whole input; a key that starts empty holds text."""
    if lines:
        first = spark.read.text(path).where(F.col("value").rlike(r"\S")).select("value")
    else:
        arrays = _array_files(spark, path).where(F.col("value").rlike(_OPENS_ARRAY))
        first = arrays.select(F.get_json_object("value", "$[0]").alias("value"))
    start = first.select(F.from_json("value", "map<string, string>")).head()
    keys = (start[0] if start is not None else None) or {}
    options = {"multiLine": not lines, "samplingRatio": sampling_ratio}
    inferred = three_types(spark.read.options(**options).json(path).schema) if keys else []
    text = T.StringType()
    return T.StructType(
        [
            f if keys[f.name] is not None else T.StructField(f.name, text)
            for f in inferred
            if f.name in keys
        ]
    )


def id_number_pairs(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """The first two fields of each line as ``(id STRING, value DOUBLE)``, header skipped.

    Lines without a number in second place are left out.
    """
    fields = T.StructType(
        [T.StructField("id", T.StringType()), T.StructField("value", T.StringType())]
    )
    rows = spark.read.options(header=True, sep=separator).schema(fields).csv(path)
    number = F.col("value").try_cast("double")
    return rows.select("id", number.alias("value")).where(F.col("value").isNotNull())


def three_types(schema: T.StructType) -> T.StructType:
    """Fold inferred types to integer (INT or BIGINT), double and string."""

    def folded(dtype: T.DataType) -> T.DataType:
        if isinstance(dtype, T.IntegralType):
            return dtype
        return T.DoubleType() if isinstance(dtype, T.NumericType) else T.StringType()

    return T.StructType([T.StructField(f.name, folded(f.dataType)) for f in schema])


def _text_fields(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _all_text(schema: T.StructType) -> T.StructType:
    return _text_fields(schema).add(_CORRUPT, T.StringType())


def _typed(
    raw: DataFrame, schema: T.StructType, malformed: str | Column, broken: Column | None = None, text: Column | None = None
) -> Split:
    """The fields of ``raw`` in the types of ``schema``. A row is ``malformed`` where it is ``broken``, and then stands as
    ``text`` among the rejected; by default both are told by the corrupt record."""
    malformed = F.lit(malformed) if isinstance(malformed, str) else malformed
    broken = F.col(_CORRUPT).isNotNull() if broken is None else broken
    reasons = [F.when(broken, malformed)]
    typed: list[Column] = []
    for field in schema:
        text_of, value = col(field.name), col(field.name)
        if not isinstance(field.dataType, T.StringType):
            value = F.trim(text_of).try_cast(field.dataType)
            unfit = F.coalesce(text_of, F.lit("")) != ""
            reasons.append(F.when(unfit & value.isNull(), F.lit(f"type:{field.name}")))
        typed.append(value.alias(field.name))
    # Spark refuses to read the corrupt-record column alone, so the checks also touch a field.
    any_text = F.coalesce(F.length(col(schema[0].name)), F.lit(0)) >= 0
    reasons.append(F.when(~any_text, malformed))
    record = F.when(broken, F.col(_CORRUPT) if text is None else text).otherwise(as_record(raw.drop(_CORRUPT, _LINE)))
    return record_split(raw, typed, F.coalesce(*reasons), record, ~broken & any_text)


def record_split(
    raw: DataFrame, typed: list[Column], reason: Column, record: Column, read: Column
) -> Split:
    """Typed columns, and for the rows at fault the reason and the row as text.

    ``read`` tells whether the row could be read as such, whatever the values of its numbers.
    """
    faults = [reason.alias("motivo"), record.alias("registro"), read.alias(_READ)]
    marked = raw.select(*typed, *faults)
    columns = tuple(marked.columns[: len(typed)])
    return Split(marked, columns, ("motivo", "registro"))


def as_record(raw: DataFrame) -> Column:
    """A row as one text."""
    return F.to_json(F.struct(*map(col, raw.columns)))
