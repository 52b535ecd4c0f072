import pytest
from pyspark.sql import functions as F

from reelspark.functions import masking as m
from reelspark.operators.masking import detect_pii_columns, mask_table

CASES = [
    (m.mask_email, "jane.doe@x.org", "j******e@x.org"),
    (m.mask_email, "ab@x.io", "a*@x.io"),
    (m.mask_email, "@x.io", "*@x.io"),
    (m.mask_email, "a@b@c", "a*@b"),
    (m.mask_email, "nobody", "nobody"),
    (m.mask_email, None, ""),
    (m.mask_phone, "+1-555-010-1234", "***-***-1234"),
    (m.mask_phone, "12", "***"),
    (m.mask_phone, "", ""),
    (m.mask_phone, None, ""),
    (m.mask_ip, "10.1.2.3", "10.1.*.*"),
    (m.mask_ip, "999.999.999.999", "999.999.*.*"),
    (m.mask_ip, "1.2.3", "1.2.3"),
    (m.mask_ip, "1.2.3.4.5", "1.2.3.4.5"),
    (m.mask_ip, None, ""),
]


@pytest.mark.parametrize("mask,value,expected", CASES)
def test_masks(spark, mask, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(mask(F.col("v"))).first()[0] == expected


@pytest.mark.parametrize("value", ["10.1.2.3", "x", "1.2.*.*"])
def test_ip_mask_is_idempotent(spark, value):
    df = spark.createDataFrame([(value,)], "v string")
    once = m.mask_ip(F.col("v"))
    assert df.select(once == m.mask_ip(once)).first()[0]


def test_table_and_report(spark):
    row = ("U1", "t.user@x.io", "+1-555-123-4567", "10.0.0.1", "Basic SD", "Ann", "12345")
    names = "user_id email phone ip_address plan_name name zip".split()
    df = spark.createDataFrame([row], names)
    masked = mask_table(df).first()
    assert masked.ip_address == "10.0.*.*"
    assert "*" in masked.email and masked.phone == "***-***-4567"
    assert mask_table(df, ips=False).first().ip_address == "10.0.0.1"
    found = {r.column_name: r.pii_type for r in detect_pii_columns(df).collect()}
    assert set(found) == {"email", "phone", "ip_address", "name", "zip"}
