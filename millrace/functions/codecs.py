"""Key and value codecs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def memcomparable_hex(raw: Column) -> Column:
    """Order-preserving encoding of bytes, in hex: groups of eight, each with a byte that tells its padding."""
    raw = raw.cast("binary")
    groups = F.sequence(F.lit(0), F.floor(F.length(raw) / 8).cast("int"))

    def group(i: Column) -> Column:
        part = F.hex(F.substring(raw, i * 8 + 1, F.lit(8)))
        mark = F.lit(255) - (F.lit(8) - F.length(part) / 2).cast("int")
        return F.concat(F.rpad(part, 16, "0"), F.hex(mark.cast("long")))

    return F.when(raw.isNotNull(), F.array_join(F.transform(groups, group), ""))


def memcomparable(raw: Column) -> Column:
    return F.unhex(memcomparable_hex(raw))


def from_memcomparable(encoded: Column) -> Column:
    """The bytes that ``memcomparable`` was given."""
    text = F.hex(encoded)
    groups = F.sequence(F.lit(0), (F.length(text) / 18 - 1).cast("int"))

    def part(i: Column) -> Column:
        padding = F.lit(255) - F.conv(F.substring(text, i * 18 + 17, F.lit(2)), 16, 10).cast("int")
        return F.substring(text, i * 18 + 1, (F.lit(8) - padding) * 2)

    return F.unhex(F.array_join(F.transform(groups, part), ""))


def key_text(raw: Column) -> Column:
    """A string key: UTF-8 without the zero bytes that pad it."""
    return F.translate(F.decode(raw, "UTF-8"), "\0", "")


def packed_datetime(packed: Column) -> Column:
    """A date and time packed as ((year * 13 + month) << 5 | day) << 17 | hour << 12 | minute << 6 | second, << 24 | microsecond.

    Zero is the first day of year 1. The result has no time zone: read it in local time or, for
    timestamps, as UTC.
    """
    whole, micros = F.shiftright(packed, 24), packed.bitwiseAND(F.lit((1 << 24) - 1))
    date, time = F.shiftright(whole, 17), whole.bitwiseAND(F.lit((1 << 17) - 1))
    months, day = F.shiftright(date, 5), date.bitwiseAND(F.lit(31))
    hour, minute, second = F.shiftright(time, 12), F.shiftright(time, 6).bitwiseAND(F.lit(63)), time.bitwiseAND(F.lit(63))
    seconds = (second + micros / F.lit(1_000_000)).cast("decimal(16,6)")
    found = F.make_timestamp_ntz(F.floor(months / 13).cast("int"), (months % 13).cast("int"), day.cast("int"), hour.cast("int"), minute.cast("int"), seconds)
    return F.when(packed == 0, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")).otherwise(found)


def pack_datetime(at: Column) -> Column:
    """The inverse of ``packed_datetime``."""
    second = F.date_part(F.lit("SECOND"), at)
    date = F.shiftleft((F.year(at) * 13 + F.month(at)).cast("long"), 5).bitwiseOR(F.dayofmonth(at).cast("long"))
    time = F.shiftleft(F.hour(at).cast("long"), 12).bitwiseOR(F.shiftleft(F.minute(at).cast("long"), 6)).bitwiseOR(F.floor(second).cast("long"))
    micros = F.round((second - F.floor(second)) * 1_000_000).cast("long")
    return F.shiftleft(F.shiftleft(date, 17).bitwiseOR(time), 24).bitwiseOR(micros)


def table_range(table_id: Column) -> tuple[Column, Column]:
    """First key and first key behind the rows of a table: ``t``, the id in order-preserving form, ``_r`` or ``_s``."""
    number = F.unhex(F.lpad(F.hex(table_id.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))
    at = lambda mark: F.concat(F.encode(F.lit("t"), "UTF-8"), number, F.encode(F.lit(mark), "UTF-8"))
    return at("_r"), at("_s")


#: Fixed first bytes of the parts of a composite key.
NIL, BYTES, INT, UINT = "00", "01", "03", "04"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_SIGN = -(1 << 63)


def _eight(number: Column) -> Column:
    return F.lpad(F.hex(number), 16, "0")


def _part(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, _WHOLE):
        body = F.concat(F.lit(INT), _eight(value.cast("long").bitwiseXOR(F.lit(_SIGN))))
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        body = F.concat(F.lit(BYTES), memcomparable_hex(value))
    elif isinstance(kind, (T.TimestampNTZType, T.DateType)):
        body = F.concat(F.lit(UINT), _eight(pack_datetime(value.cast("timestamp_ntz"))))
    else:
        raise ValueError(f"{kind.simpleString()} can't be part of a key")
    return F.coalesce(body, F.lit(NIL))


def encode_key(columns: dict[str, T.DataType]) -> Column:
    """A composite key as bytes that sort like its columns, nulls first: each part is its kind and an order-preserving form.

    ``columns`` are names and types: whole numbers, text, bytes, dates and times without a zone.
    """
    return F.unhex(F.concat(*[_part(F.col(f"`{name}`"), kind) for name, kind in columns.items()]))


def decode_key(rows: DataFrame, key: str, schema: T.StructType) -> DataFrame:
    """``rows`` with a column for each field of ``schema``, read from the composite key in the column ``key``.

    Parts have no common length, so the key is walked: each part begins where the one before ended. Text ends with the first
    group of eight bytes that isn't full. A part of another kind than its field's, and bytes that are left over or
    missing, fail the query; of a null key all columns are null.
    """
    kinds = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(_kind(f.dataType)).alias("mark")) for f in schema.fields])
    start = F.struct(F.hex(F.col(key)).alias("rest"), F.array().cast("array<string>").alias("parts"))

    def step(walk: Column, kind: Column) -> Column:
        body = _body(walk["rest"], kind)
        return F.struct(F.substring(walk["rest"], F.length(body) + 3, F.length(walk["rest"])).alias("rest"), F.array_append(walk["parts"], body).alias("parts"))

    left = F.raise_error(F.lit("bytes behind the key's last column")).cast("array<string>")
    parts = F.aggregate(kinds, start, step, lambda w: F.when(w["rest"].isNull(), F.lit(None)).when(w["rest"] == "", w["parts"]).otherwise(left))
    walked = rows.withColumn("_key_parts", parts)
    values = {f.name: _value(F.get("_key_parts", F.lit(i)), f.dataType) for i, f in enumerate(schema.fields)}
    return walked.withColumns(values).drop("_key_parts")


def _kind(kind: T.DataType) -> str:
    return BYTES if isinstance(kind, (T.StringType, T.BinaryType)) else INT if isinstance(kind, _WHOLE) else UINT


def _body(rest: Column, kind: Column) -> Column:
    """The hex digits of the part that ``rest`` begins with, without its mark; empty for a null."""
    behind = F.substring(rest, F.lit(3), F.length(rest))
    # A full group ends with FF.
    body = F.when(kind["mark"] == BYTES, F.regexp_extract(behind, "^((?:.{16}FF)*+.{18})", 1)).otherwise(F.substring(behind, F.lit(1), F.lit(16)))
    wrong = F.raise_error(F.concat(F.lit("no part of the kind of "), kind["name"])).cast("string")
    mark = F.substring(rest, F.lit(1), F.lit(2))
    return F.when(mark == NIL, F.lit("")).when((mark == kind["mark"]) & (F.length(behind) >= 16), body).when(rest.isNotNull(), wrong)


def _value(part: Column, kind: T.DataType) -> Column:
    digits = F.nullif(part, F.lit(""))
    number = F.conv(digits, 16, -10).cast("long")
    if _kind(kind) == BYTES:
        return from_memcomparable(F.unhex(digits)).cast(kind)
    return number.bitwiseXOR(F.lit(_SIGN)).cast(kind) if _kind(kind) == INT else packed_datetime(number).cast(kind)
