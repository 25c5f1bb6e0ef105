"""CSV and JSON landing files, with every unloadable row kept for quarantine.

Columns are read as text and cast afterwards. A row is flagged when its field
count differs from the contract or when a value does not cast, and the flag
expression names every column, so a later projection cannot hide a bad value.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockwell.functions import cast_errors
from stockwell.session import materialized

ERRORS = "_errors"
LINE = "_line"
FILE = "_file"
EXTRA = "_extra"
_CORRUPT = "_corrupt"
CANDIDATE_DELIMITERS = (",", ";", "|", "\t")

#: Streams take files however much older they are than the newest one; Spark's own limit is a week.
MAX_FILE_AGE = "36500d"


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream.option("maxFileAge", MAX_FILE_AGE) if streaming else spark.read


def _file_uri():
    return F.col("_metadata.file_path")


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    delimiter: str = ",",
    streaming: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Typed columns plus ``_errors``, ``_line`` and ``_file``.

    One header line per file is skipped and no quote character is defined.
    ``_errors`` is empty for a loadable row; otherwise it holds ``field_count``
    or the names of the columns that did not cast.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    text = text.add(_CORRUPT, T.StringType())
    settings = {
        **(options or {}),
        "header": "true",
        "sep": delimiter,
        "quote": "",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "columnPruning": "false",
        "enforceSchema": "true",
    }
    where = path if isinstance(path, str) or streaming else list(path)
    raw = _reader(spark, streaming).schema(text).options(**settings).csv(where)
    names = [f.name for f in schema.fields]
    errors = cast_errors({n: F.col(n) for n in names}, {f.name: f.dataType for f in schema.fields})
    as_read = F.concat_ws(delimiter, *[F.coalesce(F.col(n), F.lit("")) for n in names])
    return raw.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields],
        F.when(F.col(_CORRUPT).isNotNull(), F.array(F.lit("field_count")))
        .otherwise(errors)
        .alias(ERRORS),
        F.coalesce(_CORRUPT, as_read).alias(LINE),
        _file_uri().alias(FILE),
    )


def read_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    streaming: bool = False,
    options: Mapping[str, str] | None = None,
    missing: str = "null",
) -> DataFrame:
    """JSON-lines landing files in the shape of :func:`read_csv`.

    A line with an unknown or repeated field is flagged as ``field_count``; so is one
    that lacks a field with ``missing="error"``, else that field is read as NULL.
    """
    if missing not in ("null", "error"):
        raise ValueError("missing is null or error")
    names = [f.name for f in schema.fields]
    strings = T.StructType([T.StructField(n, T.StringType()) for n in names]).add(_CORRUPT, T.StringType())
    parsed = F.from_json(
        "value", strings, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    raw = (
        _reader(spark, streaming)
        .options(**(options or {}))
        .text(path)
        .filter(F.trim("value") != "")
        .select(parsed.alias("r"), "value", _file_uri().alias(FILE))
    )
    errors = cast_errors(
        {n: F.col(f"r.{n}") for n in names}, {f.name: f.dataType for f in schema.fields}
    )
    found, known = F.json_object_keys("value"), F.array(*[F.lit(n) for n in names])
    broken = F.col("r").isNull() | F.col(f"r.{_CORRUPT}").isNotNull() | found.isNull()
    other = (F.size(F.array_except(found, known)) > 0) | (F.size(found) > F.size(F.array_distinct(found)))
    if missing == "error":
        other = other | (F.size(F.array_except(known, found)) > 0)
    return raw.select(
        *[F.col(f"r.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields],
        F.when(broken, F.array(F.lit("malformed")))
        .when(other, F.array(F.lit("field_count")))
        .otherwise(errors)
        .alias(ERRORS),
        F.col("value").alias(LINE),
        FILE,
    )


def loadable(landed: DataFrame) -> DataFrame:
    return landed.filter(F.size(ERRORS) == 0).drop(ERRORS, LINE, FILE)


def quarantined(landed: DataFrame) -> DataFrame:
    return landed.filter(F.size(ERRORS) > 0).select(FILE, LINE, ERRORS)


def detect_delimiters(
    spark: SparkSession,
    path: str,
    field_count: int,
    candidates: Sequence[str] = CANDIDATE_DELIMITERS,
) -> DataFrame:
    """Per file: the delimiter under which most lines have ``field_count`` fields."""

    def fields(delimiter: str):
        return F.length("value") - F.length(F.replace("value", F.lit(delimiter), F.lit(""))) + 1

    scored = (
        spark.read.text(path)
        .groupBy(_file_uri().alias(FILE))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            *[F.count_if(fields(d) == field_count).alias(f"_fit_{i}") for i, d in enumerate(candidates)],
        )
    )
    best = F.greatest(*[F.col(f"_fit_{i}") for i in range(len(candidates))])
    chosen = F.lit(None).cast("string")
    for i, d in reversed(list(enumerate(candidates))):
        chosen = F.when(F.col(f"_fit_{i}") == best, F.lit(d)).otherwise(chosen)
    return scored.select(
        FILE, "lines", best.alias("fitting_lines"), F.when(best > 0, chosen).alias("delimiter")
    )


def literal_path(path: str) -> str:
    """A path that Spark reads as it stands, brackets and all."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def plain_file() -> Column:
    """The path of a row's file as text; file metadata hold it with %20 and the like."""
    return F.url_decode(F.replace(_file_uri(), F.lit("+"), F.lit("%2B")))


def text_lines(spark: SparkSession, path: str | Sequence[str], streaming: bool = False, options: Mapping[str, str] | None = None) -> DataFrame:
    """``value, _file, _start``: lines with their file and block.

    A file stream reads other files twice if one of a batch has a glob character in its path,
    so a stream fails on such a name.
    """
    where = path if isinstance(path, str) or streaming else list(path)
    lines = _reader(spark, streaming).options(**(options or {})).text(where)
    file = plain_file()
    if streaming:
        message = F.concat(F.lit("a stream cannot read a file with glob characters in its path: "), file)
        file = F.when(file.rlike(r"[\[\]{}*?\\]"), F.raise_error(message).cast("string")).otherwise(file)
    return lines.select("value", file.alias(FILE), F.col("_metadata.file_block_start").alias("_start"))


def _parts(value: Column, delimiter: Column) -> Column:
    return F.split(value, F.concat(F.lit("\\Q"), delimiter, F.lit("\\E")), -1)


def file_layouts(lines: DataFrame, schema: T.StructType, delimiter: str | None = None) -> DataFrame:
    """Per file ``_file, delimiter, names, _header``: a table, however many files there are.

    The header is the first line of the file. Without a given ``delimiter`` it is the candidate
    under which the header names most columns of ``schema``, else has as many
    fields, else the first one.
    """
    known = F.array(*[F.lit(f.name.lower()) for f in schema.fields])
    first = (
        lines.where(F.col("_start") == 0)
        .groupBy(FILE)
        .agg(F.min_by(F.struct("value", "_row"), "_row").alias("h"))
        .select(FILE, F.col("h.value").alias("header"), F.col("h._row").alias("_header"))
    )
    chosen = F.lit(delimiter)
    if delimiter is None:
        fits = [
            F.struct(
                F.size(F.array_intersect(F.transform(_parts(F.col("header"), F.lit(d)), lambda n: F.lower(F.trim(n))), known)).alias("named"),
                (F.size(_parts(F.col("header"), F.lit(d))) == len(schema.fields)).alias("wide"),
                F.lit(-i).alias("place"),
                F.lit(d).alias("d"),
            )
            for i, d in enumerate(CANDIDATE_DELIMITERS)
        ]
        chosen = F.greatest(*fits)["d"]
    named = first.withColumn("delimiter", chosen)
    names = F.transform(_parts(F.col("header"), F.col("delimiter")), lambda n: F.lower(F.trim(n)))
    return named.select(FILE, "delimiter", names.alias("names"), "_header")


def typed_lines(
    lines: DataFrame, layouts: DataFrame, schema: T.StructType, by_name: bool, extra: Sequence[str] | None = None
) -> DataFrame:
    """Lines under their own file's layout, in the shape of :func:`read_csv`.

    ``by_name`` takes a column from where the file's header has it, NULL if it has none, and
    anything else by position. ``extra`` columns are added as text; ``None`` keeps all that the
    contract does not know as one map, ``_extra``. Layouts are joined by file.
    """
    rows = lines.where(F.trim("value") != "").join(layouts, FILE).where(F.col("_row") != F.col("_header"))
    rows = rows.withColumn("_fields", _parts(F.col("value"), F.col("delimiter")))
    position = {f.name: i for i, f in enumerate(schema.fields)}

    def field(name: str) -> Column:
        place = F.array_position("names", F.lit(name.lower())) - 1 if by_name else F.lit(position[name])
        value = F.get("_fields", place.cast("int"))
        return F.when(value != "", value)

    known = {f.name: field(f.name) for f in schema.fields}
    errors = cast_errors(known, {f.name: f.dataType for f in schema.fields})
    width = F.size("names") if by_name else F.lit(len(schema.fields))
    repeated = F.size("names") > F.size(F.array_distinct("names")) if by_name else F.lit(False)
    if extra is None:
        own = F.array(*[F.lit(f.name.lower()) for f in schema.fields])
        pairs = F.filter(F.arrays_zip(F.col("names").alias("key"), F.col("_fields").alias("value")), lambda p: ~F.array_contains(own, p["key"]))
        fitting = (F.size("_fields") == F.size("names")) & ~repeated
        others = [F.when(fitting & F.lit(by_name), F.map_from_entries(pairs)).alias(EXTRA)]
    else:
        others = [field(n).alias(n) for n in extra]
    return rows.select(
        *[v.try_cast(schema[n].dataType).alias(n) for n, v in known.items()],
        *others,
        F.when((F.size("_fields") != width) | repeated, F.array(F.lit("field_count"))).otherwise(errors).alias(ERRORS),
        F.col("value").alias(LINE),
        FILE,
    )


def numbered(lines: DataFrame) -> DataFrame:
    return lines.withColumn("_row", F.monotonically_increasing_id())


def read_csv_detected(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Load every file under its own delimiter, columns by position; misfits still go to quarantine.

    Layouts stay a table: neither names nor headers of files come to the driver. An empty
    folder gives no rows.
    """
    lines = numbered(text_lines(spark, path))
    return typed_lines(lines, file_layouts(lines, schema), schema, by_name=False, extra=())


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """First line of every file. Lines of a file's first block are read in
    order by one task, so the smallest row id marks the header."""
    lines = numbered(text_lines(spark, path)).where(F.col("_start") == 0)
    return lines.groupBy(FILE).agg(F.min_by("value", "_row").alias("header"))


def read_csv_evolving(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ","
) -> DataFrame:
    """Load files whose headers differ. Known columns keep their types; a new
    column arrives as text and is NULL for files that lack it.

    Of the files only the distinct names of new columns come to the driver.
    """
    lines = numbered(text_lines(spark, path))
    layouts = materialized(file_layouts(lines, schema, delimiter), "layouts")
    names = layouts.select(F.explode("names").alias("name")).distinct()
    known = [f.name.lower() for f in schema.fields]
    extra = sorted(r["name"] for r in names.where(~F.col("name").isin(known) & (F.col("name") != "")).collect())
    return typed_lines(lines, layouts, schema, by_name=True, extra=extra)
