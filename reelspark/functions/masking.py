"""Masking of e-mail addresses, phone numbers and IP addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(c: Column) -> Column:
    """Keep the first and last character of the local part."""
    local = F.split_part(c, F.lit("@"), F.lit(1))
    domain = F.split_part(c, F.lit("@"), F.lit(2))
    length = F.char_length(local)
    middle = F.when(length <= 2, F.lit("*")).otherwise(
        F.concat(F.repeat(F.lit("*"), length - 2), F.right(local, F.lit(1)))
    )
    masked = F.concat(F.left(local, F.lit(1)), middle, F.lit("@"), domain)
    return F.when(c.isNull(), F.lit("")).when(F.contains(c, F.lit("@")), masked).otherwise(c)


def mask_phone(c: Column) -> Column:
    """Keep the last four digits."""
    digits = F.regexp_replace(c, r"[^\p{Nd}]", "")
    return (
        F.when(c.isNull() | (c == ""), F.lit(""))
        .when(F.char_length(digits) < 4, F.lit("***"))
        .otherwise(F.concat(F.lit("***-***-"), F.right(digits, F.lit(4))))
    )


def mask_ip(c: Column) -> Column:
    """Keep the first two of four dotted parts; other text is unchanged."""
    quad = r"\A([^.]*)\.([^.]*)\.[^.]*\.[^.]*\z"
    return F.coalesce(F.regexp_replace(c, quad, "$1.$2.*.*"), F.lit(""))
