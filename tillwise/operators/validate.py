"""Data-quality rules: schema checks, one-pass row rules, key and reference rules.

A row rule is a named predicate that is true for an offending row. A predicate
that is null (a null in the checked column) does not offend.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.contracts import SALES, Contract, SalesColumns
from tillwise.operators.aggregates import duplicate_keys
from tillwise.operators.joins import orphans

# The email pattern and the coordinate ranges.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)

TOTAL = "total_records"


class ValidationError(ValueError):
    """Raised by the fail-fast checks."""


# ------------------------------------------------------------------ schema rules


def schema_problems(df: DataFrame, contract: Contract) -> list[str]:
    """Missing columns and wrong types, from metadata only."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for column in contract.columns:
        if column.name not in have:
            problems.append(f"missing column {column.name}")
        elif type(have[column.name]) is not type(column.type):
            problems.append(
                f"column {column.name} is {have[column.name].simpleString()},"
                f" expected {column.type.simpleString()}"
            )
    return problems


# --------------------------------------------------------------------- row rules


def sale_rules(cols: SalesColumns = SALES) -> dict[str, Column]:
    """Email format, coordinate ranges and sign of the quantity of an enriched sale."""
    return {
        "email_format": ~F.col(cols.email).rlike(EMAIL_PATTERN),
        "latitude_range": ~F.col(cols.latitude).between(*LATITUDE_RANGE),
        "longitude_range": ~F.col(cols.longitude).between(*LONGITUDE_RANGE),
        "quantity_negative": F.col(cols.quantity) < 0,
    }


def contract_rules(contract: Contract, *, narrow: bool = False) -> dict[str, Column]:
    """NOT NULL, CHECK and length rules of a table.

    ``narrow`` adds the ranges of the declared types, for tables that are kept in these.
    """
    rules: dict[str, Column] = {}
    for c in contract.columns:
        value = F.col(c.name)
        if c.required:
            rules[f"{c.name}_not_null"] = value.isNull()
        if c.max_length is not None:
            rules[f"{c.name}_length"] = F.length(value) > c.max_length
        if narrow and c.declared is not None:
            rules[f"{c.name}_fits"] = _too_wide(value, c.type, c.declared)
    for name, check in contract.checks.items():
        rules[name] = ~F.expr(check)
    return rules


def _too_wide(value: Column, held: T.DataType, declared: T.DataType) -> Column:
    """True when the value, rounded to the declared scale, does not fit. A plain comparison,
    since casting every value to find out costs far more. NaN does not fit."""
    if isinstance(declared, T.IntegerType):
        return ~value.between(-(2**31), 2**31 - 1)
    whole = declared.precision - declared.scale
    if isinstance(held, T.DecimalType) and held.scale <= declared.scale:
        first_misfit = Decimal(10) ** whole
    else:
        # values from half a step below the limit are rounded up to it
        first_misfit = Decimal(10) ** whole - Decimal(5) / Decimal(10) ** (declared.scale + 1)
    return F.abs(value) >= F.lit(first_misfit)


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, violations) for all rules and the record count, in a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias(TOTAL),
        *[F.count_if(offends).alias(name) for name, offends in rules.items()],
    )
    return _as_rows(counts)


def offending_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break at least one rule, with the names of the broken rules."""
    names = F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in rules.items()]))
    return df.withColumn("broken_rules", names).where(F.size("broken_rules") > 0)


def passing_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that break no rule."""
    bad = reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules.values()])
    return df.where(~bad)


# ----------------------------------------------------------- key and reference rules


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key, as one (rule, violations) row."""
    extra = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(f"{'_'.join(key)}_unique")
    return _as_rows(duplicate_keys(df, key).agg(extra))


def reference_violations(
    df: DataFrame, column: str, parents: DataFrame, parent_column: str
) -> DataFrame:
    """Lines that name a missing parent, as one (rule, violations) row."""
    lines = F.coalesce(F.sum("lines"), F.lit(0)).alias(f"{column}_reference")
    return _as_rows(orphans(df, column, parents, parent_column).agg(lines))


def key_conflicts(
    held: DataFrame | Mapping[tuple[str, ...], DataFrame], fresh: DataFrame, contract: Contract
) -> DataFrame:
    """Keys of the contract that ``fresh`` rows would break beside the ``held`` ones.

    (rule, violations) for every key: rows beyond the first. Only held rows that share a
    key with a fresh one are looked at. ``held`` may name other rows for each key to be checked.
    """
    parts = []
    for key in contract.keys if isinstance(held, DataFrame) else held:
        new = fresh.select(*key).dropna()
        rows = held if isinstance(held, DataFrame) else held[key]
        same = rows.select(*key).join(new, list(key), "left_semi")
        parts.append(key_violations(same.unionByName(new), key))
    return reduce(DataFrame.unionByName, parts)


def constraint_report(
    df: DataFrame,
    contract: Contract,
    parents: Mapping[str, DataFrame] | None = None,
    *,
    narrow: bool = True,
) -> DataFrame:
    """Every rule of a table contract as (rule, violations), with the declared ranges.

    ``parents`` maps a referenced table's name to its frame. All row rules take one
    pass; every key and reference adds one over its own columns, so ``df`` should be
    a table or a staged frame.
    """
    parts = [rule_report(df, contract_rules(contract, narrow=narrow))]
    parts += [key_violations(df, key) for key in contract.keys]
    for column, (table, parent_column) in contract.references.items():
        parts.append(reference_violations(df, column, (parents or {})[table], parent_column))
    return reduce(DataFrame.unionByName, parts)


def fail_on_violations(report: DataFrame) -> None:
    """Raise when any rule of the report was broken. One job, one row back."""
    broken = F.concat_ws(": ", "rule", F.col("violations").cast("string"))
    found = (
        report.where((F.col("rule") != TOTAL) & (F.col("violations") > 0))
        .agg(F.array_join(F.sort_array(F.collect_list(broken)), ", ").alias("text"))
        .first()
    )
    if found["text"]:
        raise ValidationError(found["text"])


def check_sales(enriched: DataFrame, contract: Contract, cols: SalesColumns = SALES) -> None:
    """Schema first, then the sale rules; raises on the first kind that fails."""
    fail_on_schema(enriched, contract)
    fail_on_violations(rule_report(enriched, sale_rules(cols)))


def fail_on_schema(df: DataFrame, contract: Contract) -> None:
    problems = schema_problems(df, contract)
    if problems:
        raise ValidationError("; ".join(problems))


def _as_rows(counts: DataFrame) -> DataFrame:
    """One row of counts to one row per rule."""
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations"))
        for name in counts.columns
    ]
    return counts.select(F.inline(F.array(*entries)))
