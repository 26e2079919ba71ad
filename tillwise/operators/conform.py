"""Casting a frame to the types of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.contracts import Contract


def conform(
    df: DataFrame, contract: Contract, *, narrow: bool = False, on_overflow: str = "error"
) -> DataFrame:
    """The contract's columns, in order and in its types.

    ``narrow`` uses the declared types instead of the wider working ones. A value
    that does not fit stops the job, or becomes null with ``on_overflow="null"``;
    the range rules of ``contract_rules`` count such values beforehand.
    """
    if on_overflow not in ("error", "null"):
        raise ValueError(f"unknown overflow mode {on_overflow!r}")
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in contract.columns:
        wanted = (c.declared or c.type) if narrow else c.type
        value = F.col(c.name)
        if have.get(c.name) == wanted:
            out.append(value)
            continue
        fitted = value.try_cast(wanted)
        if on_overflow == "error":
            message = F.lit(f"{contract.name}.{c.name} does not fit {wanted.simpleString()}")
            lost = value.isNotNull() & fitted.isNull()
            fitted = F.when(lost, F.raise_error(message).cast(wanted)).otherwise(fitted)
        out.append(fitted.alias(c.name))
    return df.select(*out)
