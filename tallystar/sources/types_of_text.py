"""Types of columns that were read as text, from one aggregate over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a field may be, most narrow first. Java reads a number also with blanks around it and with a letter for its type.
_WHOLE = r"^[+-]?[0-9]+\z"
_POINTED = r"^[+-]?[0-9]+\.?\z"
_NUMBER = r"^\s*[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)[fFdD]?)\s*\z"
_ENDLESS = ["Inf", "-Inf", "NaN"]
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_MOST_DIGITS = 38


def _kind(field: Column) -> Column:
    def reads(kind: str) -> Column:
        return field.try_cast(kind).isNotNull()

    whole = field.rlike(_WHOLE)
    return (
        F.when(whole & reads("int"), "int")
        .when(whole & reads("bigint"), "bigint")
        .when(field.rlike(_POINTED) & reads(f"decimal({_MOST_DIGITS},0)"), "decimal")
        .when(field.rlike(_NUMBER) | field.isin(_ENDLESS), "double")
        .when(field.rlike(_DAY) & reads("date"), "date")
        .when(reads("timestamp"), "timestamp")
        .when(F.lower(field).isin("true", "false"), "boolean")
        .when(field.isNotNull(), "string")
    )


def _widest(kinds: set[str], digits: int | None) -> T.DataType:
    """The type that holds fields of all ``kinds``: numbers widen, dates and timestamps are timestamps, others are text."""
    if kinds <= {"int"} and kinds:
        return T.IntegerType()
    if kinds <= {"int", "bigint"} and kinds:
        return T.LongType()
    if kinds <= {"int", "bigint", "decimal"} and kinds:
        return T.DecimalType(max(digits, 20 if "bigint" in kinds else 10 if "int" in kinds else 1), 0)
    if kinds <= {"int", "bigint", "decimal", "double"} and kinds:
        return T.DoubleType()
    single = {"date": T.DateType(), "boolean": T.BooleanType()}
    if len(kinds) == 1 and kinds <= set(single):
        return single[next(iter(kinds))]
    if kinds <= {"date", "timestamp"} and kinds:
        return T.TimestampType()
    return T.StringType()


def types_of(text: DataFrame) -> T.StructType:
    """The types that the CSV reader would infer for the text columns of ``text``, as a schema in their order.

    A number with an exponent is always a double. Nulls are of every type; a column of nulls only, or of an empty table, is text. One pass: each column gives at most eight kinds and a
    number of digits. Pass a pinned table, so that the text is parsed once.
    """
    aggregates = []
    for i, name in enumerate(text.columns):
        field = F.col(f"`{name}`")
        aggregates.append(F.collect_set(_kind(field)).alias(f"kinds{i}"))
        digits = F.length(F.regexp_replace(field, r"^[+-]?0*|\.\z", ""))
        aggregates.append(F.max(F.when(field.rlike(_POINTED), digits)).alias(f"digits{i}"))
    found = text.agg(*aggregates).first()  # one row
    return T.StructType([T.StructField(name, _widest(set(found[f"kinds{i}"]), found[f"digits{i}"])) for i, name in enumerate(text.columns)])


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """The text columns of ``text`` cast to ``schema``, whose types ``types_of`` found for them, so that every field can be cast."""

    def cast(f: T.StructField) -> Column:
        field = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):  # a cast knows no letter for the type, and no blanks but spaces
            field = F.regexp_replace(F.trim(field), r"(?<=[0-9.])[fFdD]\z", "")
        return field.cast(f.dataType).alias(f.name)

    return text.select(*map(cast, schema))
