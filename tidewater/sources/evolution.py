"""Schema evolution: which fields landed, and the contract widened to hold them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.contracts import Contract, Field
from tidewater.sources.rescue import TEXT_MAP, typed


def observed_fields(lines: DataFrame, contract: Contract, text_column: str = "value") -> DataFrame:
    """One row per field name found in JSON lines: how often it is present, null, or a misfit.

    Rows are pre-aggregated by field name before the shuffle, so a field that is
    in every line costs no more than a rare one.
    """
    entries = lines.select(
        F.explode(F.from_json(F.col(text_column), TEXT_MAP)).alias("name", "text")
    )
    misfit = F.lit(False)
    for f in contract.fields:
        misfit = F.when(F.col("name") == f.name, typed(F.col("text"), f).isNull()).otherwise(misfit)
    return entries.groupBy("name").agg(
        F.count("*").alias("present"),
        F.count_if(F.col("text").isNull()).alias("nulls"),
        F.count_if(F.col("text").isNotNull() & misfit).alias("misfits"),
    )


class TooManyFields(RuntimeError):
    """The lines have more field names than a schema can have."""


def evolve(contract: Contract, observed: DataFrame, most: int = 2_000) -> Contract:
    """The contract under its evolution mode.

    ``none`` keeps it (new fields are rescued).  ``additive`` adds new fields as
    text columns.  ``all`` also turns fields with misfit values into text.
    ``observed`` has one row per field name.  A producer that uses ids as names would make it as large as the
    data: more than ``most`` names are refused.
    """
    if contract.evolution_mode == "none":
        return contract
    declared = {f.name for f in contract.fields}
    names = observed.select("name", "misfits").limit(most + 1).collect()
    if len(names) > most:
        raise TooManyFields(f"{contract.domain}: more than {most} field names")
    seen = {r["name"]: r["misfits"] for r in names}
    fields = contract.fields
    if contract.evolution_mode == "all":
        fields = tuple(replace(f, type="StringType") if seen.get(f.name) else f for f in fields)
    added = tuple(Field(name, "StringType") for name in sorted(seen) if name not in declared)
    return contract.with_options(fields=fields + added)
