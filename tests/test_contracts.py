from result_helpers import final_plan
from pyspark.sql.types import StructType

from fareloom.operators.contracts import (
    EXTRA,
    MISSING,
    NULLABILITY,
    TYPE,
    conform,
    contract_report,
    findings_by_kind,
    schema_findings,
)

WANTED = StructType().add("id", "integer", False).add("name", "string").add("amount", "double").add("flag", "boolean")


def test_every_kind_of_finding():
    actual = StructType().add("name", "string", False).add("id", "long", False).add("amount", "double")
    actual = actual.add("more", "integer")
    grouped = findings_by_kind(schema_findings(actual, WANTED))
    assert grouped[MISSING] == ["flag"]
    assert grouped[EXTRA] == ["more"]
    assert [item["field"] for item in grouped[TYPE]] == ["id"]
    assert grouped[NULLABILITY] == [{"field": "name", "expected": True, "actual": False}]


def test_same_schema_has_no_findings():
    assert schema_findings(WANTED, WANTED) == []
    assert not any(findings_by_kind([]).values())


def test_severities():
    actual = StructType().add("id", "integer", True).add("name", "string", False).add("amount", "string")
    actual = actual.add("x", "integer")
    severity = {(f.kind, f.field): f.severity for f in schema_findings(actual, WANTED)}
    assert severity == {
        (MISSING, "flag"): "error",
        (TYPE, "amount"): "error",
        (NULLABILITY, "id"): "data",
        (NULLABILITY, "name"): "info",
        (EXTRA, "x"): "info",
    }


def test_field_names_are_compared_exactly():
    upper, lower = (StructType().add(name, "integer", False) for name in ("ID", "id"))
    grouped = findings_by_kind(schema_findings(upper, lower))
    assert grouped[MISSING] == ["id"] and grouped[EXTRA] == ["ID"]


def test_report_counts_nulls(spark):
    df = spark.createDataFrame([(1, None, "1"), (None, None, "2")], "id int, name string, amount string")
    report = {row.field: row for row in contract_report(df, WANTED).collect()}
    assert [report[name].status for name in WANTED.fieldNames()] == ["nulls found", "ok", "wrong type", "missing"]
    assert [report[name].null_count for name in WANTED.fieldNames()] == [1, 2, 0, None]
    assert (report["amount"].expected_type, report["amount"].actual_type) == ("double", "string")
    assert report["flag"].actual_type is None
    assert [report[name].nullable for name in WANTED.fieldNames()] == [False, True, True, True]


def test_report_of_unrelated_table(spark):
    report = contract_report(spark.range(3).withColumnRenamed("id", "other"), WANTED).collect()
    assert {row.status for row in report} == {"missing"}


def test_report_scans_once(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1.0, True)], WANTED).write.parquet(str(tmp_path / "t"))
    assert final_plan(contract_report(spark.read.parquet(str(tmp_path / "t")), WANTED)).count("FileScan parquet") == 1


def test_conform_orders_and_drops(spark):
    df = spark.sql("SELECT true AS flag, 1.0D AS amount, 'x' AS extra, 'n' AS name, 1 AS id")
    assert conform(df, WANTED).columns == ["id", "name", "amount", "flag"]
