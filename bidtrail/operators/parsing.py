"""Text lines to typed rows, with bad lines kept aside instead of stopping the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import cast_text
from ..schemas import all_string

REJECT = "reject_reason"


def drop_empty(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that hold any text."""
    return lines.where(F.col(column) != "")


def parse_lines(lines: DataFrame, schema: T.StructType, column: str = "value", separator: str = "\\t") -> DataFrame:
    """One typed row per line, plus reject_reason (null for a good line).

    Fields after the last declared one are ignored.  An empty field is a null of every type but text.  A line with
    too few fields, or with a text that is not of its column's type, keeps what could be read and states the reason.
    """
    kept = [c for c in lines.columns if c != column]
    # Exploding a single array keeps its rows, and keeps Spark from pushing a filter on the result below it: the line
    # is split once, and every field is converted once, whatever looks at the outcome.
    parts = lines.select(*kept, F.explode(F.array(F.split(column, separator))).alias("_parts"))
    texts = {f.name: F.get("_parts", F.lit(i)) for i, f in enumerate(schema.fields)}
    typed = F.struct(*[cast_text(texts[f.name], f.dataType).alias(f.name) for f in schema.fields])
    rows = parts.select(*kept, "_parts", F.explode(F.array(typed)).alias("_row"))
    failed = [
        F.when((texts[f.name] != "") & _unread(F.col("_row")[f.name], f.dataType), F.lit(f.name))
        for f in schema.fields
        if not isinstance(f.dataType, (T.StringType, T.BooleanType, T.BinaryType))
    ]
    bad = F.concat_ws(",", *failed) if failed else F.lit("")
    reason = (
        F.when(F.col("_parts").isNull() | (F.size("_parts") < len(schema.fields)), "too few fields")
        .when(bad != "", F.concat(F.lit("bad value: "), bad))
    )
    judged = rows.select(*kept, "_row", F.explode(F.array(F.struct(reason.alias(REJECT)))).alias("_why"))
    return judged.select(*kept, *[F.col("_row")[n].alias(n) for n in schema.names], F.col("_why")[REJECT].alias(REJECT))


def _unread(value: Column, kind: T.DataType) -> Column:
    """Whether a converted value lost its text."""
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, T.StringType):
        return F.exists(value, lambda x: x.isNull())
    return value.isNull()


def parse_lines_as_strings(lines: DataFrame, schema: T.StructType, column: str = "value", separator: str = "\\t") -> DataFrame:
    """The same without any conversion."""
    return parse_lines(lines, all_string(schema), column, separator)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT).isNull()).drop(REJECT)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT).isNotNull())
