"""Comparison of a table with its declared schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The kinds of finding.
MISSING = "missing_fields"
EXTRA = "extra_fields"
TYPE = "datatype_mismatches"
NULLABILITY = "nullability_mismatches"


@dataclass(frozen=True)
class SchemaFinding:
    kind: str
    field: str
    expected: object = None
    actual: object = None

    @property
    def severity(self) -> str:
        """Error: the table does not fit. Data: decided by null counts, not by the schema. Info: harmless."""
        if self.kind in (MISSING, TYPE):
            return "error"
        return "data" if self.kind == NULLABILITY and self.actual else "info"


def schema_findings(actual: StructType, expected: StructType) -> list[SchemaFinding]:
    """Top-level differences by exact field name."""
    have = {field.name: field for field in actual}
    want = {field.name: field for field in expected}
    findings = [SchemaFinding(MISSING, name) for name in want if name not in have]
    findings += [SchemaFinding(EXTRA, name) for name in have if name not in want]
    for name in want.keys() & have.keys():
        for kind, attribute in ((TYPE, "dataType"), (NULLABILITY, "nullable")):
            pair = getattr(want[name], attribute), getattr(have[name], attribute)
            if pair[0] != pair[1]:
                findings.append(SchemaFinding(kind, name, *pair))
    order = {name: i for i, name in enumerate([*want, *have])}
    return sorted(findings, key=lambda finding: (finding.kind, order[finding.field]))


def findings_by_kind(findings: list[SchemaFinding]) -> dict[str, list]:
    """Findings as four lists: bare names for missing and extra fields, detail dictionaries for the others."""
    grouped: dict[str, list] = {MISSING: [], EXTRA: [], TYPE: [], NULLABILITY: []}
    for finding in findings:
        detail = {"field": finding.field, "expected": finding.expected, "actual": finding.actual}
        grouped[finding.kind].append(finding.field if finding.kind in (MISSING, EXTRA) else detail)
    return grouped


def contract_report(df: DataFrame, contract: StructType) -> DataFrame:
    """One row per contract field: declared and actual type, null count and status.

    Null counts of all fields come from one scan. A field that must not be null is judged by its data, because a
    Parquet scan declares every column nullable.
    """
    actual = {field.name: field.dataType.simpleString() for field in df.schema}
    present = [field.name for field in contract if field.name in actual]
    counts = df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in present] or [F.count("*")])

    def row(field):
        found, wanted = actual.get(field.name), field.dataType.simpleString()
        nulls = F.col(f"`{field.name}`") if found else F.lit(None).cast("bigint")
        if found is None:
            status = F.lit("missing")
        elif found != wanted:
            status = F.lit("wrong type")
        elif field.nullable:
            status = F.lit("ok")
        else:
            status = F.when(nulls > 0, "nulls found").otherwise("ok")
        return F.struct(
            F.lit(field.name).alias("field"),
            F.lit(wanted).alias("expected_type"),
            F.lit(found).cast("string").alias("actual_type"),
            F.lit(field.nullable).alias("nullable"),
            nulls.alias("null_count"),
            status.alias("status"),
        )

    return counts.select(F.inline(F.array(*[row(field) for field in contract])))


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """The contract's columns in the contract's order; other columns are left out."""
    return df.select(contract.fieldNames())
