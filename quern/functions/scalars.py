"""Scalar functions as Spark expressions; all stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(content: Column) -> Column:
    """SHA-256 in lower-case hex; null for null content."""
    return F.sha2(content, 256)


def class_offset(name: Column) -> Column:
    """A stable number below 2**31 from a class name: the low bits of its MD5."""
    return F.conv(F.right(F.md5(name.cast("binary")), F.lit(8)), 16, 10).cast("long").bitwiseAND(F.lit(2**31 - 1).cast("long"))


#: Fixed value: the odd factor by which an index enters a seed.
INDEX_FACTOR = 6700417


def row_seed(seed: int, offset: Column, index: Column) -> Column:
    """The seed of a generated row, distinct by class and index."""
    return F.lit(seed).cast("long").bitwiseXOR(offset).bitwiseXOR(index.cast("long") * F.lit(INDEX_FACTOR).cast("long"))


def suffix(name: Column) -> Column:
    """The extension with its dot in lower case; a leading dot alone begins no extension."""
    return F.lower(F.regexp_extract(name, r"(?<=.)(\.[^./]+)$", 1))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_name(path: Column) -> Column:
    """The name of the folder a path lies in."""
    return F.element_at(F.split(path, "/"), -2)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where whole is 0."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def half_even(x: Column) -> Column:
    """Rounded to an integer, halves to the even one."""
    return F.bround(x, 0).cast("long")


def hash_hex(bits: Column) -> Column:
    """64 bits as 16 hex digits; null for null."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))


def hamming(a: Column, b: Column) -> Column:
    """In how many of their bits two numbers differ."""
    return F.bit_count(a.bitwiseXOR(b))


def bits_of(flags: Column) -> Column:
    """An array of 64 booleans as a number, the first flag its lowest bit."""
    return F.aggregate(F.transform(flags, lambda f, i: F.when(f, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f names it; a lambda would repeat it for each element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def median_hash(values: Column) -> Column:
    """The last step of a perceptual hash: 64 coefficients, each a bit if above their median."""

    def middle(v: Column) -> Column:
        return bound(F.array_sort(v), lambda ordered: (F.element_at(ordered, 32) + F.element_at(ordered, 33)) / 2)

    return bound(values, lambda v: bound(middle(v), lambda m: bits_of(F.transform(v, lambda x: x > m))))


def gradient_hash(values: Column) -> Column:
    """A difference hash over a row of 64 values: a bit if the next value is larger; the last bit is 0."""
    return bound(values, lambda v: bits_of(F.transform(v, lambda x, i: F.coalesce(F.get(v, i + 1) > x, F.lit(False)))))


def argmax(values: Column) -> Column:
    """The first place, from 0, of an array's largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def hours_minutes_seconds(seconds: Column) -> Column:
    """Whole seconds as h:mm:ss."""
    whole = seconds.cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(whole / 3600), F.floor(F.pmod(whole, F.lit(3600)) / 60), F.pmod(whole, F.lit(60)))


def timestamp_text(at: Column) -> Column:
    """A moment as year-month-day hours:minutes:seconds in the session's time zone; null for null."""
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def milliseconds_each(seconds: Column, items: Column) -> Column:
    """Milliseconds an item where a number of them took seconds; null where there are none."""
    return F.try_divide(seconds * F.lit(1000.0), items)


def without_fields(record: Column, *names: str) -> Column:
    """A nested record without some of its fields."""
    return record.dropFields(*names)
