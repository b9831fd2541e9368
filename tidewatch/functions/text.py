"""Text formatting helpers.

Java's ``%.Nf`` rounds half up on the shortest decimal form while Python
and DuckDB round the exact binary value half to even (SURVEY N4), so every
fixed-decimal rendering first rounds with ``rint`` and then formats a value
that already has at most N decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.functions.numeric import ColumnOrName, col_, rnd


def fixed(x: ColumnOrName, places: int) -> Column:
    """``f"{x:.{places}f}"`` with half-to-even rounding.

    The value is rounded with ``rint`` and rendered through a DECIMAL of the
    same scale, which stays in generated code (``format_string`` calls
    ``java.util.Formatter`` per row).  For non-negative values the text is
    the same as ``%.Nf``."""
    return rnd(x, places).cast(f"decimal(18,{places})").cast("string")


def template(fmt: str, *args: Column) -> Column:
    """A ``%s`` / ``%d`` text template filled with Column values by ``concat``
    (stays in generated code; ``format_string`` runs java.util.Formatter per
    row).  Integral arguments render as with ``%d``; ``%%`` is a literal %."""
    import re
    pieces = re.split(r"%[sd]", fmt)
    if len(pieces) != len(args) + 1:
        raise ValueError("template arity mismatch")
    parts: list[Column] = []
    for i, piece in enumerate(pieces):
        if piece:
            parts.append(F.lit(piece.replace("%%", "%")))
        if i < len(args):
            parts.append(args[i].cast("string"))
    return F.concat(*parts)


def thousands(x: ColumnOrName) -> Column:
    """``f"{n:,}"`` for an integral value."""
    return F.format_number(col_(x).cast("bigint"), 0)


def with_unit(x: ColumnOrName, places: int, unit: str) -> Column:
    """fixed decimals followed by a display unit (``"12.50 %"``)."""
    return F.concat(fixed(x, places), F.lit(unit))


def dataset_of_topic(topic: ColumnOrName) -> Column:
    """The part of a topic name after its first hyphen."""
    return F.split(col_(topic), "-").getItem(1)


def link_hash(link: ColumnOrName) -> Column:
    """MD5 hex digest of a link (the report message key)."""
    return F.md5(col_(link).cast("string"))


def minute_text(ts: ColumnOrName) -> Column:
    """local minute-resolution text, ``yyyy-MM-ddTHH:mm``."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm")


def second_text(ts: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (analysis time stamp)."""
    return F.date_format(col_(ts), "yyyy-MM-dd HH:mm:ss")


def archive_stamp_text(ts: ColumnOrName) -> Column:
    """``yyyy-MM-dd_HH-mm-ss`` (archive object names)."""
    return F.date_format(col_(ts), "yyyy-MM-dd_HH-mm-ss")


def iso_text(ts: ColumnOrName) -> Column:
    """ISO-8601 local time with microseconds."""
    return F.date_format(col_(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
