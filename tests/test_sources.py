"""S1/S2 staging: fixed schema, header order, bad values, missing values."""

import os

import pytest
from pyspark.sql import types as T

from starloom.sources.csv_stage import missing_required, read_extract

SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("order_date", T.DateType(), False),
        T.StructField("quantity", T.IntegerType(), False),
    ]
)


def write(tmp_path, name, text):
    d = tmp_path / name
    os.makedirs(d)
    (d / "part-0.csv").write_text(text)
    return str(d)


def test_good_extract_loads(spark, tmp_path):
    p = write(tmp_path, "ok", "order_id,order_date,quantity\n1,2024-01-02,3\n2,2024-01-03,4\n")
    df = read_extract(spark, p, SCHEMA)
    assert sorted(tuple(r) for r in df.collect())[0][0] == 1
    assert missing_required(df, SCHEMA) == 0


def test_reordered_header_is_refused(spark, tmp_path):
    p = write(tmp_path, "reordered", "order_date,order_id,quantity\n2024-01-02,1,3\n")
    with pytest.raises(Exception):
        read_extract(spark, p, SCHEMA).collect()


def test_bad_date_fails_fast(spark, tmp_path):
    p = write(tmp_path, "baddate", "order_id,order_date,quantity\n1,02/01/2024,3\n")
    with pytest.raises(Exception):
        read_extract(spark, p, SCHEMA).collect()


def test_empty_required_field_is_reported(spark, tmp_path):
    p = write(tmp_path, "empty", "order_id,order_date,quantity\n1,2024-01-02,\n2,2024-01-03,4\n")
    assert missing_required(read_extract(spark, p, SCHEMA), SCHEMA) == 1
