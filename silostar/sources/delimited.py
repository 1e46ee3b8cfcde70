"""Delimited text files, read as text with the null rules of the raw layer.

* the literal ``NULL`` is null
* an empty field is an empty string
* a field that a short row does not have is null; fields beyond the header are dropped
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silostar.model import COUNTRY_COLUMNS, SCORE_COLUMNS, Source
from silostar.operators.ranking import first_per_key

_BAD = "_bad_record"
_NEVER = "\u0001"  # null marker that no file contains

NULL_TEXT = "NULL"  # fixed value: how the files write a null


def _strip(c: str) -> Column:
    return F.btrim(F.col(c), F.lit(" \t\n\r\u000b\u000c"))


def header_map(columns: Sequence[str], header: Sequence[str]) -> dict[str, str]:
    """Map header names to snake_case columns: equal but for case and underscores
    (``shipPostalCode`` is ``ship_postal_code``)."""
    by_name = {h.lower().replace("_", ""): h for h in header}
    found = {c: by_name.get(c.replace("_", "")) for c in columns}
    return {h: c for c, h in found.items() if h is not None}


# How records end. Files are split among tasks, but for MULTI_LINE.
ANY = None  # CR LF, LF or CR: a field cannot hold a line break
CRLF = "\r\n"  # CR LF only: fields may hold LF
MULTI_LINE = "multi-line"  # fields may hold any break: the file is read by one task


def record_end(spark: SparkSession, path: str) -> str | None:
    """CRLF if the first line ends so, else ANY. The other records must end alike, which is
    checked when they are read."""
    first = spark.read.option("lineSep", "\n").text(path).first()
    return CRLF if first is not None and first.value.endswith("\r") else ANY


def _scan(
    spark: SparkSession, path: str, separator: str, ends: str | None
) -> tuple[DataFrame, list[str]]:
    """Every field of the file as text, by position ``_f0.._fn``, with the raw text of the
    records whose number of fields differs from the header's."""
    options = {
        "header": True, "sep": separator, "quote": '"', "escape": '"', "encoding": "UTF-8",
        "multiLine": ends == MULTI_LINE, "nullValue": _NEVER, "emptyValue": "",
        "inferSchema": False, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    }
    if ends == CRLF:
        options["lineSep"] = CRLF
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(h, T.StringType()) for h in [*header, _BAD]])
    # columnPruning off: a pruned parse cannot tell short and long records.
    rows = (
        spark.read.options(**options)
        .options(
            columnNameOfCorruptRecord=_BAD, mode="PERMISSIVE", enforceSchema=False,
            columnPruning=False,
        )
        .schema(schema)
        .csv(path)
    )
    return rows, header


def _field_count(separator: str, width: int) -> Column:
    """Fields a record really has; quoted text is taken out before counting separators."""
    bare = F.regexp_replace(F.col(_BAD), '"[^"]*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1
    return F.when(F.col(_BAD).isNull(), F.lit(width)).otherwise(found)


def read_raw(
    spark: SparkSession, path: str, columns: Sequence[str] | Mapping[str, str],
    delimiter: str = ",", multi_line: bool = False, keep: Sequence[Column] = (),
    ends: str | None = ANY,
) -> DataFrame:
    """The raw layer of a file: the chosen columns, all text.

    ``columns`` is either a map of header name to column name, or column names to find in
    the header by rule. A column the header lacks is null. Files are split among tasks. A
    field with a line break then gives records that do not fit and have an unpaired quote,
    which raises. If the records of the file end in CR LF and its fields hold LF alone, it is
    still split with ``ends=CRLF`` (see ``record_end``); any other such file is to be read with
    ``multi_line=True``, as a whole in one task.
    """
    ends = MULTI_LINE if multi_line else ends
    rows, header = _scan(spark, path, delimiter, ends)
    mapping = dict(columns) if isinstance(columns, Mapping) else header_map(columns, header)
    wanted = list(mapping.values()) if isinstance(columns, Mapping) else list(columns)
    position = {mapping[h]: i for i, h in enumerate(header) if h in mapping}

    count = _field_count(delimiter, len(header))
    if ends != MULTI_LINE:
        quotes = F.length(_BAD) - F.length(F.replace(F.col(_BAD), F.lit('"'), F.lit("")))
        cut = F.concat(F.lit(f"{path}: a field holds a line break, use multi_line: "), F.col(_BAD))
        wrong = quotes % 2 == 1
        if ends == CRLF:  # records that end in LF alone come as one
            wrong = wrong | F.contains(F.regexp_replace(F.col(_BAD), '"[^"]*"', ""), F.lit("\n"))
        count = F.when(wrong, F.raise_error(cut).cast("int")).otherwise(count)
    selected = []
    for c in wanted:
        if c not in position:
            selected.append(F.lit(None).cast("string").alias(c))
            continue
        i = position[c]
        field = F.col(f"`{header[i]}`")
        # Spark gives null for an empty field, so null means empty wherever the record
        # is long enough to have the field.
        text = F.when(count > i, F.coalesce(field, F.lit("")))
        selected.append(F.nullif(text, F.lit(NULL_TEXT)).alias(c))
    return rows.select(*selected, *keep, (count < len(header)).alias("_short")).drop(
        *([] if keep else ["_short"])
    )


def read_source(
    spark: SparkSession, folder: str, source: Source, multi_line: bool = False,
    ends: str | None = ANY,
) -> DataFrame:
    """The raw layer of a declared input file."""
    return read_raw(
        spark, f"{folder}/{source.file}", source.columns, source.separator, multi_line, ends=ends
    )


def read_scores(
    spark: SparkSession, path: str, multi_line: bool = False, ends: str | None = ANY
) -> tuple[DataFrame, DataFrame]:
    """Customer scores as text, stripped, blanks kept; and the records too short to hold
    a score, which are not loaded."""
    rows = read_raw(
        spark, path, SCORE_COLUMNS, ";", multi_line, [F.col(_BAD).alias("record")], ends
    )
    plain = [F.coalesce(_strip(c), F.lit("")).alias(c) for c in SCORE_COLUMNS.values()]
    return (
        rows.filter(~F.col("_short")).select(*plain),
        rows.filter("_short").select("customer_id", "record"),
    )


def read_country_attributes(
    spark: SparkSession, path: str, multi_line: bool = False, ends: str | None = ANY
) -> DataFrame:
    """Seven columns of the country file, stripped; the last record of a country counts.
    Blank coordinates become null."""
    place = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    ]
    rows = read_raw(spark, path, COUNTRY_COLUMNS, ",", multi_line, place, ends)
    last = first_per_key(rows, ["country"], [F.desc("_file"), F.desc("_block"), F.desc("_line")])
    text = [
        F.coalesce(_strip(c), F.lit("")).alias(c)
        for c in ("iso_code", "capital", "official_language", "currency_code")
    ]
    numbers = [
        F.nullif(_strip(c), F.lit("")).alias(c) for c in ("latitude", "longitude")
    ]
    return last.select("country", *text, *numbers)
