"""Typing landed text: declared columns, plus a rescued-data column for what does not fit.

``_rescued_data`` is NULL for a clean row.  Otherwise it is a JSON object with the
original text of every value of the wrong type and of every undeclared field;
a line that cannot be read at all is kept whole under ``_malformed``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.contracts import Contract, Field

MALFORMED_KEY = "_malformed"
SOURCE_FILE = "_source_file"
TEXT_MAP = T.MapType(T.StringType(), T.StringType())


def typed(text: Column, field: Field) -> Column:
    """The text as the declared type, NULL where it does not fit."""
    if isinstance(field.spark_type, T.StringType):
        return text
    return text.try_cast(field.spark_type)


def _is_misfit(text: Column, field: Field) -> Column:
    return text.isNotNull() & typed(text, field).isNull()


def _misfit_map(texts: dict[str, Column], fields: Sequence[Field]) -> Column:
    """Text of the declared fields that do not fit their type."""
    entries = [
        F.when(_is_misfit(texts[f.name], f), F.struct(F.lit(f.name).alias("key"), texts[f.name].alias("value")))
        for f in fields
    ]
    return F.map_from_entries(F.array_compact(F.array(*entries)))


def _rescued(texts: dict[str, Column], fields: Sequence[Field], has_extras: Column, extras: Column) -> Column:
    """JSON of misfits and extra fields, NULL for a clean row.

    A clean row only costs the checks; maps and JSON are built for the others.
    """
    fallible = [f for f in fields if not isinstance(f.spark_type, T.StringType)]
    extras_json = F.to_json(extras)
    if not fallible:
        return F.when(has_extras, extras_json)
    has_misfits = reduce(lambda a, b: a | b, (_is_misfit(texts[f.name], f) for f in fallible))
    misfits_json = F.to_json(_misfit_map(texts, fallible))
    # The two objects are joined as text: a line may repeat a key, which no map would accept.
    joined = F.concat(_without_last(misfits_json), F.lit(","), _without_first(extras_json))
    return (
        F.when(has_misfits & has_extras, joined).when(has_misfits, misfits_json).when(has_extras, extras_json)
    )


def _without_last(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - 1)


def _without_first(text: Column) -> Column:
    return F.substring(text, F.lit(2), F.length(text))


def _extra_columns(columns: Sequence[str]) -> tuple[Column, Column]:
    """(any value present, map of the values as text) of undeclared columns."""
    if not columns:
        return F.lit(False), F.create_map().cast(TEXT_MAP)
    pairs = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")))
        for c in columns
    ]
    texts = [F.col(c).cast("string") for c in columns]
    return F.coalesce(*texts).isNotNull(), F.map_from_entries(F.array_compact(F.array(*pairs)))


def _malformed(line: Column) -> Column:
    return F.to_json(F.create_map(F.lit(MALFORMED_KEY), line))


def _one_object(line: Column) -> Column:
    """The line's object, NULL if text follows it, which the parser would leave out without a word.

    A flat object has one brace of each kind and ends with it; only other lines are parsed once more,
    as the one element that a list of them must have.  Braces are found by a search over bytes: this runs for every line.
    """
    bare = F.replace(F.replace(line, F.lit("{"), F.lit("")), F.lit("}"), F.lit(""))
    braces = F.octet_length(line) - F.octet_length(bare)
    plain = (braces == 2) & F.rtrim(line).endswith("}")
    alone = plain | (F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1)
    return F.when(alone, F.from_json(line, TEXT_MAP))


def type_json_lines(lines: DataFrame, contract: Contract, text_column: str = "value") -> DataFrame:
    """Text lines, one JSON object each, to contract columns and rescued data.

    Each line is parsed once.  A declared field that is also a column of
    ``lines`` (a partition directory of the landing area) fills gaps in the text;
    other columns are kept.
    """
    names = [f.name for f in contract.fields]
    kept = [c for c in lines.columns if c != text_column and c not in names]
    # As the output of a generator the parsed map is never copied into the filters and
    # columns above it, each of which would parse the line again.
    parsed = lines.select("*", F.explode(F.array(_one_object(F.col(text_column)))).alias("_parsed"))
    texts = {
        n: F.coalesce(F.col("_parsed")[n], F.col(n).cast("string")) if n in lines.columns else F.col("_parsed")[n]
        for n in names
    }
    has_extras = F.size(F.array_except(F.map_keys("_parsed"), F.array(*map(F.lit, names)))) > 0
    extras = F.map_filter("_parsed", lambda key, _: ~key.isin(names))
    line = F.col(text_column)
    rescued = F.when(F.col("_parsed").isNull() & line.isNotNull(), _malformed(line)).otherwise(_rescued(texts, contract.fields, has_extras, extras))
    return parsed.select(
        *(typed(texts[f.name], f).alias(f.name) for f in contract.fields),
        rescued.alias(contract.rescued_column),
        *kept,
    )


def type_text_columns(
    rows: DataFrame, contract: Contract, corrupt_column: str | None = None, extras: Sequence[str] = ()
) -> DataFrame:
    """All-text columns (CSV, or drifted columnar files) to contract columns and rescued data."""
    known = {f.name for f in contract.fields}
    kept = [c for c in rows.columns if c not in known and c != corrupt_column and c not in extras]
    present = set(rows.columns)
    texts = {
        f.name: F.col(f.name) if f.name in present else F.lit(None).cast("string") for f in contract.fields
    }
    rescued = _rescued(texts, contract.fields, *_extra_columns(extras))
    if corrupt_column:
        corrupt = F.col(corrupt_column)
        rescued = F.when(corrupt.isNotNull(), _malformed(corrupt)).otherwise(rescued)
    return rows.select(
        *(typed(texts[f.name], f).alias(f.name) for f in contract.fields),
        rescued.alias(contract.rescued_column),
        *kept,
    )


def type_columnar(rows: DataFrame, contract: Contract) -> DataFrame:
    """Columns read with the file's own types to contract columns and rescued data.

    A column already of the declared type passes through untouched, so filters
    on it still reach the scan; only drifted columns go through text.
    """
    own = {f.name: f.dataType for f in rows.schema.fields}
    fits = [f for f in contract.fields if f.name in own and _same_type(own[f.name], f.spark_type)]
    drifted = [f for f in contract.fields if f.name in own and f not in fits]
    declared = {f.name for f in contract.fields}
    extras = [n for n in own if n not in declared and n != SOURCE_FILE]
    texts = {f.name: F.col(f.name).cast("string") for f in drifted}
    rescued = F.lit(None).cast("string")
    if drifted or extras:
        rescued = _rescued(texts, drifted, *_extra_columns(extras))

    def column(f: Field) -> Column:
        if f in fits:
            return F.col(f.name).cast(f.spark_type) if own[f.name] != f.spark_type else F.col(f.name)
        if f in drifted:
            return typed(texts[f.name], f)
        return F.lit(None).cast(f.spark_type)

    return rows.select(
        *(column(f).alias(f.name) for f in contract.fields),
        rescued.alias(contract.rescued_column),
        *([SOURCE_FILE] if SOURCE_FILE in own else []),
    )


def _same_type(own: T.DataType, declared: T.DataType) -> bool:
    timestamps = (T.TimestampType, T.TimestampNTZType)
    return own == declared or (isinstance(own, timestamps) and isinstance(declared, T.TimestampType))
