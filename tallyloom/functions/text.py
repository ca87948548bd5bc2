"""Text, hash, time and key expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as a plain non-negative number in text.
NUMBER_PATTERN = r"^\d+(\.\d+)?$"
# A signed decimal or scientific number; keeps out 'nan', '1.5d' and the like, which a
# plain cast would accept.
LOOSE_NUMBER_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


# Fixed value: white space at the ends of a text.
WHITE_SPACE = " \t\n\r\x0b\x0c"


def trimmed(col: Column) -> Column:
    """Without white space of any kind at the ends; NULL stays NULL."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def to_number(col: Column) -> Column:
    """Text or number to double; blanks and anything unparsable become NULL, never NaN."""
    text = trimmed(col.cast("string"))
    return F.when(text.rlike(LOOSE_NUMBER_PATTERN), text.try_cast("double"))


def to_integer(col: Column) -> Column:
    """Whole-number coercion; a fractional or unparsable value becomes NULL."""
    number = to_number(col)
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column in one projection; NULL stays NULL."""
    return df.select(
        *[
            trimmed(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def pseudonym(col: Column) -> Column:
    """First 16 hex digits of SHA-256; a null or empty id gives NULL."""
    text = col.cast("string")
    return F.when(F.length(text) > 0, F.substring(F.sha2(text, 256), 1, 16))


def request_id_or_new(col: Column) -> Column:
    """The given request id, else a fresh one."""
    return F.coalesce(F.when(F.length(col) > 0, col), F.expr("uuid()"))


def first_hop(forwarded: Column, host: Column | None = None) -> Column:
    """First address of a forwarding header, else the peer host, else 'unknown'."""
    first = F.when(F.length(forwarded) > 0, F.trim(F.split(forwarded, ",").getItem(0)))
    return F.coalesce(first, host, F.lit("unknown")) if host is not None else F.coalesce(
        first, F.lit("unknown")
    )


def seeded_hash(seed: int, key: Column) -> Column:
    """32 hex digits that depend on the seed and the key only, not on row placement."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_number(hashed: Column, digits: int = 8) -> Column:
    """The leading hex digits of a hash as a BIGINT."""
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")


def utc_micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp column, whatever the session zone.

    A zone-less timestamp is read as UTC; for a zoned one pass ``unix_micros`` directly.
    """
    return F.expr(
        f"unix_micros(from_utc_timestamp(cast(`{ts}` as timestamp), current_timezone()))"
    )


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
