"""Data contracts: what a table must hold before it is published.

A run gives a DataFrame (table, check, violations). ``enforce`` raises on any violation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from marquee.functions.vectors import is_vector


class ContractError(ValueError):
    """A table does not hold to its contract."""


@dataclass(frozen=True)
class Contract:
    """Columns, key and value rules of one table."""

    table: str
    required: tuple[str, ...]
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    integer: tuple[str, ...] = ()
    vectors: dict[str, int] = field(default_factory=dict)
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)


MOVIES = Contract("movies", ("movie_id", "title", "genres"), ("movie_id",), not_null=("title",), integer=("movie_id",))
RATINGS = Contract(
    "ratings",
    ("user_id", "movie_id", "rating", "rated_at"),
    ("user_id", "movie_id"),
    not_null=("rating",),
    integer=("user_id", "movie_id"),
    ranges={"rating": (0.5, 5.0)},
    references={"movie_id": "movies"},
)


def factor_contract(table: str, id_column: str, dim: int = 50, features: str = "features") -> Contract:
    return Contract(
        table, (id_column, features), (id_column,), not_null=(features,), integer=(id_column,), vectors={features: dim}
    )


def schema_problems(df: DataFrame, contract: Contract) -> list[str]:
    """What the schema alone shows: missing columns, ids that are no integers."""
    problems = [f"missing column {c}" for c in contract.required if c not in df.columns]
    types = {f.name: f.dataType for f in df.schema.fields}
    whole = (T.IntegerType, T.LongType)
    problems += [f"not an integer {c}" for c in contract.integer if c in types and not isinstance(types[c], whole)]
    return problems


def row_rules(contract: Contract) -> dict[str, Column]:
    """Rules that one row alone can break, each true where it is broken."""
    rules = {f"null key {c}": F.col(c).isNull() for c in contract.key}
    rules |= {f"null {c}": F.col(c).isNull() for c in contract.not_null}
    rules |= {f"vector length {c}": F.col(c).isNotNull() & ~is_vector(F.col(c), dim) for c, dim in contract.vectors.items()}
    rules |= {f"out of range {c}": ~F.col(c).between(low, high) for c, (low, high) in contract.ranges.items()}
    return rules


def check(df: DataFrame, contract: Contract, referenced: dict[str, DataFrame] | None = None) -> DataFrame:
    """All rules of the contract: one aggregate for the row rules, one for the key, one per reference."""
    missing = [c for c in contract.required if c not in df.columns]
    if missing:
        raise ContractError(f"{contract.table}: missing columns {missing}")
    rules = row_rules(contract)
    totals = df.agg(
        (F.count("*") == 0).cast("bigint").alias("empty"),
        *[F.count_if(broken).alias(name) for name, broken in rules.items()],
    )
    parts = [_long(totals)]
    repeated = df.groupBy(*contract.key).agg(F.count("*").alias("copies")).agg(F.count_if(F.col("copies") > 1).alias("repeated key"))
    parts.append(_long(repeated))
    for column, table in contract.references.items():
        if referenced and table in referenced:
            lost = orphans_by_key(df, referenced[table], column)
            parts.append(_long(lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(f"orphan {column}"))))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(F.lit(contract.table).alias("table"), "check", "violations")


def _long(totals: DataFrame) -> DataFrame:
    """One row of named counts as (check, violations) rows."""
    pairs = [
        F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").cast("bigint").alias("violations")) for c in totals.columns
    ]
    return totals.select(F.inline(F.array(*pairs)))


def orphans_by_key(facts: DataFrame, parents: DataFrame, column: str) -> DataFrame:
    """Keys of ``facts`` without a parent, with their row counts.

    Rows are counted per key first, so a hot key is one row by the time of the join.
    """
    counted = facts.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counted.join(parents.select(column), column, "left_anti")


def split_valid(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the row rules, and the others with the first rule they break."""
    rules = list(row_rules(contract).items())
    broken = F.lit(None).cast("string")
    for name, rule in reversed(rules):
        broken = F.when(F.coalesce(rule, F.lit(False)), name).otherwise(broken)
    return df.filter(broken.isNull()), df.filter(broken.isNotNull()).withColumn("broken_rule", broken)


def enforce(report: DataFrame) -> None:
    """Raise when a contract report shows violations. A report has one row per rule."""
    failed = report.filter("violations > 0").collect()
    if failed:
        raise ContractError("; ".join(f"{r['table']}: {r['check']} ({r['violations']})" for r in failed))


def check_factors(users: DataFrame, items: DataFrame, dim: int) -> None:
    """Raise unless all ids are integers, each once, and all vectors have length ``dim``."""
    for df, contract in (
        (users, factor_contract("user_factors", "user_id", dim)),
        (items, factor_contract("movie_factors", "movie_id", dim)),
    ):
        problems = schema_problems(df, contract)
        if problems:
            raise ContractError(f"{contract.table}: {', '.join(problems)}")
        enforce(check(df, contract))


def synthetic_check(factors: DataFrame, records: int, dim: int, table: str) -> DataFrame:
    """Generated vectors: ids 1..records each once, ``dim`` floats, all within [-1, 1]."""
    values = F.col("features")
    outside = F.coalesce(F.exists(values, lambda x: ~x.between(-1.0, 1.0)), F.lit(False))
    totals = factors.agg(
        F.abs(F.count("*") - records).alias("record count"),
        F.count_if(F.col("id").isNull()).alias("null id"),
        F.count_if(~F.col("id").between(1, records)).alias("id not in 1..n"),
        F.count_if(values.isNull()).alias("null features"),
        F.count_if(values.isNotNull() & ~is_vector(values, dim)).alias("vector length features"),
        F.count_if(outside).alias("out of range features"),
    )
    copies = factors.groupBy("id").agg(F.count("*").alias("copies")).agg(F.count_if(F.col("copies") > 1).alias("repeated id"))
    return _long(totals).unionByName(_long(copies)).select(F.lit(table).alias("table"), "check", "violations")
