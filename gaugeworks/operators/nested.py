"""Flattening and path access on semi-structured documents (R-09 to R-16).

Documents are parsed once into VARIANT; only the paths a model asks for are then read.  Flattening
is always inner: a document whose path is missing, NULL, scalar or empty yields no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def parse_documents(
    df: DataFrame, column: str = "value", into: str = "doc", lenient: bool = False, observation: Observation | None = None
) -> DataFrame:
    """Parse JSON text.  Malformed text is an error, or a NULL document if ``lenient``.

    ``observation`` gets the numbers of ``documents`` and ``malformed`` ones with the first action on the result.
    """
    parse = F.try_parse_json if lenient else F.parse_json
    parsed = df.withColumn(into, parse(F.col(column)))
    if observation is None:
        return parsed
    return parsed.observe(observation, F.count("*").alias("documents"), F.count_if(is_malformed(column)).alias("malformed"))


def is_malformed(column: Column | str) -> Column:
    """Text that does not parse; a NULL text is no document at all."""
    text = F.col(column) if isinstance(column, str) else column
    return text.isNotNull() & F.try_parse_json(text).isNull()


def malformed_documents(df: DataFrame, column: str = "value") -> DataFrame:
    """The rows that ``lenient`` passes over, columns unchanged: what to keep in a quarantine table."""
    return df.where(is_malformed(column))


def flatten(df: DataFrame, source: str, path: str | None, into: str) -> DataFrame:
    """One row per array element, or per object member value, found at ``path`` (R-10, R-11).

    All columns of ``df`` stay beside the new one (R-15).
    """
    collection = F.col(source).outer()
    if path:
        collection = F.variant_get(collection, f"$.{path}", "variant")
    members = df.sparkSession.tvf.variant_explode(collection).select(F.col("value").alias(into))
    return df.lateralJoin(members)


def flatten_two_level(df: DataFrame, source: str, path: str, into: str) -> DataFrame:
    """Members of the object at ``path``, then elements of each member (R-09); keys are ignored."""
    group = f"__{into}_group"
    return flatten(flatten(df, source, path, group), group, None, into).drop(group)


def field(source: Column | str, path: str, data_type: str = "string", lenient: bool = False) -> Column:
    """The value at a path, cast (R-12, R-13, R-14).

    ``path`` is dotted and may index arrays (``GeoInfo.Coordinates[0].StationLatitude``); a missing
    path or an index out of range is NULL.  Quoted numbers convert.  Text that is no number is an
    error, or NULL if ``lenient``.
    """
    get = F.try_variant_get if lenient else F.variant_get
    source = F.col(source) if isinstance(source, str) else source
    return get(source, f"$.{path}", data_type)


def subdocument(source: Column | str, path: str) -> Column:
    """The part of a document at ``path`` as JSON text (R-16).

    VARIANT can be neither compared nor grouped; its JSON text can, and object members come out in
    key order and numbers in one spelling, so equal values have equal text.
    """
    return F.nullif(canonical_json(field(source, path, "variant")), F.lit("null"))


def canonical_json(value: Column | str) -> Column:
    """JSON text of a VARIANT in which equal numbers are spelled alike: ``1``, ``1.0`` and ``1e0`` are ``1``.

    Numbers come out without an exponent and without zeros at the end of a fraction.  Those of more than 38
    digits, or written with an exponent, are equal if they are the same double.
    """
    text = F.to_json(value)
    # Neither stand-in occurs in JSON text, so what is left of quotes delimits strings: odd parts are their contents.
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x01")), F.lit('\\"'), F.lit("\x02"))
    tokens = lambda part: F.regexp_extract_all(part, F.lit("-?[0-9][0-9.E+-]*|[^0-9-]+"), F.lit(0))
    outside = lambda part: F.array_join(F.transform(tokens(part), _plain_number), "")
    parts = F.transform(F.split(plain, '"'), lambda part, i: F.when(i % 2 == 0, outside(part)).otherwise(part))
    joined = F.replace(F.replace(F.array_join(parts, '"'), F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
    return F.when(text.rlike("[0-9][.]0|[0-9]E"), joined).otherwise(text)


def _plain_number(token: Column) -> Column:
    """A number as the text of a double has it (``1.0``, ``-1.25E-7``) without exponent; any other token as it is."""
    shape = "^(-?)([0-9]+)[.]([0-9]+)E(-?[0-9]+)$"
    sign, whole, fraction = (F.regexp_extract(token, shape, i) for i in (1, 2, 3))
    power = F.regexp_extract(token, shape, 4).cast("int")
    fraction = F.regexp_replace(fraction, "0+$", "")
    digits, zeros = F.length(fraction), F.lit("0")
    large = F.concat(whole, fraction, F.repeat(zeros, power - digits))
    mixed = F.concat(whole, F.substr(fraction, F.lit(1), power), F.lit("."), F.substr(fraction, power + 1))
    small = F.concat(F.lit("0."), F.repeat(zeros, -power - 1), whole, fraction)
    number = F.concat(sign, F.when(power >= digits, large).when(power >= 0, mixed).otherwise(small))
    return F.when(token.rlike(shape), number).when(token.rlike("^-?[0-9]+[.]0$"), F.regexp_replace(token, "[.]0$", "")).otherwise(token)
