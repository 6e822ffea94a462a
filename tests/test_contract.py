import json

from pyspark.sql import types as T

from freightlane.plans.contract import ColumnSpec, Contract, contract_from, read_contracts

MAPPING = {
    "source_table": "yard.parcel_scans",
    "target_table": "depot.parcel_scans",
    "columns": [
        {"source": "scan_no", "target": "scan_no", "source_type_raw": "varchar", "canonical_type": "TEXT",
         "target_type": "VARCHAR(24)", "role": "primary_key", "nullable": False, "transform": None, "warnings": []},
        {"source": "kilos", "target": "weight", "canonical_type": "DECIMAL", "target_type": "DECIMAL(12,3)",
         "role": "null", "nullable": True, "transform": None},
        {"source": "lane", "target": "lane", "canonical_type": "CLOB", "target_type": "LONGTEXT", "role": "null",
         "nullable": True, "transform": "upper(lane)"},
        {"source": "passed", "target": "passed", "canonical_type": "DATETIME", "target_type": "DATETIME(6)", "nullable": False},
    ],
    "primary_key": ["scan_no"],
    "foreign_keys": [{"column": "lane", "parent_table": "lanes", "parent_column": "code"}],
}


def test_contract_from_mapping():
    contract = contract_from(MAPPING)
    assert contract.name == "parcel_scans"
    assert contract.key == ["scan_no"]
    assert contract.targets == ["scan_no", "weight", "lane", "passed"]
    scan_no, weight, lane, passed = contract.columns
    assert (scan_no.length, scan_no.required, scan_no.role) == (24, True, "primary_key")
    assert (weight.source_name, weight.dtype, weight.role, weight.required) == ("kilos", T.DecimalType(12, 3), None, False)
    assert (lane.transform, lane.length) == ("upper(lane)", None)
    assert (passed.length, passed.required, passed.precision) == (None, True, None)
    assert contract.foreign_keys[0].parent_table == "lanes"


def test_columns_of_a_declared_key_are_required():
    contract = Contract("a.b", "a.b", (ColumnSpec("x", "INT4"), ColumnSpec("y", "INT4")), primary_key=("x",))
    assert [c.required for c in contract.columns] == [True, False]
    assert contract.schema["x"].nullable is False


def test_schema_carries_metadata():
    field = contract_from(MAPPING).schema["scan_no"]
    assert field.nullable is False
    assert field.metadata == {"canonical": "TEXT", "role": "primary_key", "max_length": 24}


def test_key_falls_back_to_roles():
    assert contract_from({**MAPPING, "primary_key": []}).key == ["scan_no"]


def test_read_contracts_in_file_order(tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.json").write_text(json.dumps({**MAPPING, "source_table": f"public.{name}"}))
    assert [c.source_table for c in read_contracts(tmp_path)] == ["public.a", "public.b"]
    assert [c.source_table for c in read_contracts(tmp_path, ["public.b"])] == ["public.b"]


def test_key_given_by_its_source_name():
    columns = [{"source": "Id", "target": "item_id", "canonical_type": "INT8", "nullable": True}]
    contract = contract_from({"source_table": "a.b", "columns": columns, "primary_key": ["Id"]})
    assert contract.key == ["item_id"] and contract.columns[0].required
    assert contract.target_table == "a.b"
