"""Mask personal data in a table by column name, and list such columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelspark.functions.masking import mask_email, mask_ip, mask_phone


def _masked(df: DataFrame, name: str, mask) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return mask(c).alias(name)
    return F.coalesce(c.cast("string"), F.lit("")).alias(name)


def mask_table(df: DataFrame, emails: bool = True, phones: bool = True, ips: bool = True) -> DataFrame:
    """Mask every column whose name speaks of mail, phone or IP addresses.

    ``ip`` counts anywhere in a name, so ``zip`` or ``description`` is treated too.
    """

    def treated(name: str) -> Column:
        low = name.lower()
        if emails and "mail" in low:
            return _masked(df, name, mask_email)
        if phones and any(word in low for word in ("phone", "mobile", "contact")):
            return _masked(df, name, mask_phone)
        if ips and "ip" in low:
            return _masked(df, name, mask_ip)
        return F.col(name)

    return df.select(*(treated(c) for c in df.columns))


# Kind of personal data, risk and treatment.
EMAIL = ("Email Address", "High", "Masked")
PHONE = ("Phone Number", "High", "Masked")
ADDRESS = ("IP Address (Network Identifier)", "Medium", "Truncated / Masked")
PERSON = ("Full Name", "Medium", "Pseudonymized / Access-Controlled")


def pii_kind(name: str) -> tuple[str, str, str] | None:
    low = name.lower()
    if "mail" in low:
        return EMAIL
    if "phone" in low or "mobile" in low:
        return PHONE
    if "ip" in low:
        return ADDRESS
    if "name" in low and low != "plan_name":
        return PERSON
    return None


def detect_pii_columns(df: DataFrame) -> DataFrame:
    """Columns that may hold personal data, with the number of values at risk."""
    kinds = [(c, kind) for c in df.columns if (kind := pii_kind(c))]
    counted = df.agg(F.lit(0).alias("_none"), *(F.count(c).alias(c) for c, _ in kinds))
    entries = F.array(
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(kind[0]).alias("pii_type"),
                F.lit(kind[1]).alias("risk"),
                F.lit(kind[2]).alias("action"),
                F.col(c).alias("values_found"),
            )
            for c, kind in kinds
        )
    ).cast(
        "array<struct<column_name:string,pii_type:string,risk:string,action:string,values_found:bigint>>"
    )
    return counted.select(F.inline(entries))
