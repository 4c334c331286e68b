"""Declared column contracts."""

from collections import Counter

import pytest

from tickerlake.schema import (
    DIMENSION_COLUMNS,
    FACT_SCHEMA,
    FLAT_SCHEMA,
    RAW_SCHEMA,
    UPDATE_COLUMNS_FULL,
    UPDATE_COLUMNS_SCHEDULED,
    schema_from_list,
)


def test_raw_contract():
    kinds = Counter(f.dataType.simpleString() for f in RAW_SCHEMA.fields)
    assert len(RAW_SCHEMA.fields) == 94
    assert kinds == {"string": 19, "double": 52, "bigint": 16, "int": 6, "date": 1}
    assert all(f.nullable for f in RAW_SCHEMA.fields)


def test_flat_fact_dimension_contracts():
    assert len(FLAT_SCHEMA.fields) == 107
    assert len(FACT_SCHEMA.fields) == 67 and len(DIMENSION_COLUMNS) == 17
    flat = set(FLAT_SCHEMA.fieldNames())
    assert set(FACT_SCHEMA.fieldNames()) <= flat and set(DIMENSION_COLUMNS) <= flat
    assert FACT_SCHEMA["numberOfAnalystOpinions"].dataType.simpleString() == "bigint"
    assert set(UPDATE_COLUMNS_SCHEDULED) <= set(UPDATE_COLUMNS_FULL)
    assert set(UPDATE_COLUMNS_FULL) - set(UPDATE_COLUMNS_SCHEDULED) == {
        "revenue_cr", "net_cash_cr", "forwardPE", "earningsGrowth", "returnOnEquity"}


def test_schema_from_list():
    s = schema_from_list([{"name": "a", "type": "long"}, ("b", "float"), {"name": "c", "type": "boolean"}])
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in s.fields] == [
        ("a", "bigint", True), ("b", "float", True), ("c", "boolean", True)]
    with pytest.raises(KeyError):
        schema_from_list([("x", "decimal")])
