"""Table profile, data rules, source coverage and unmatched-code checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import CHUNK, ordered_chunks

PROFILE_COLUMNS = (
    "table_name", "column_name", "data_type", "row_count", "not_null_proportion", "distinct_proportion",
    "distinct_count", "is_unique", "min", "max", "avg", "median", "std_dev_population", "std_dev_sample",
)


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, two hashes of the value as text, value as number, count) of values that aren't null.

    Each column is counted by a scan of its own, which reads that column alone, and partial counts of hashes are shuffled, never
    texts. So the cost is that of the columns one after the other; ``df`` should be a stored table.
    """
    numeric = {f.name for f in df.schema if isinstance(f.dataType, T.NumericType)}

    def counted(c: str) -> DataFrame:
        value = F.col(c).cast("string")
        number = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        names = [F.lit(c).alias("column_name"), F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]
        return df.where(F.col(c).isNotNull()).select(*names, number.alias("number")).groupBy("column_name", "h1", "h2", "number").count()

    return reduce(lambda a, b: a.unionAll(b), [counted(c) for c in columns])


def exact_medians(chunks: DataFrame) -> DataFrame:
    """Median per column from value counts in range chunks (no column is sorted in one task)."""
    earlier = Window.partitionBy("column_name").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column_name")
    offsets = (
        chunks.groupBy("column_name", CHUNK)
        .agg(F.sum("n").alias("__n"))
        .select(
            "column_name",
            CHUNK,
            F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
            F.sum("__n").over(whole).alias("__total"),
        )
    )
    inside = Window.partitionBy("column_name", CHUNK).orderBy("number")
    placed = chunks.withColumn("__upto", F.sum("n").over(inside)).join(offsets, ["column_name", CHUNK])
    first = F.col("__before") + F.col("__upto") - F.col("n") + 1
    last = F.col("__before") + F.col("__upto")
    low, high = F.floor((F.col("__total") + 1) / 2), F.floor((F.col("__total") + 2) / 2)
    hits = ((first <= low) & (low <= last)).cast("int") + ((first <= high) & (high <= last)).cast("int")
    return placed.withColumn("__hits", hits).where("__hits > 0").groupBy("column_name").agg(
        (F.sum(F.col("number") * F.col("__hits")) / 2).alias("median")
    )


def profile(df: DataFrame, table_name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: completeness, distinctness, range and moments."""
    fields = [f for f in df.schema if (columns is None or f.name in columns)]
    names = [f.name for f in fields]
    numeric = {f.name for f in fields if isinstance(f.dataType, T.NumericType)}

    def stat(fn, f):
        return fn(F.col(f.name).cast("double")) if f.name in numeric else F.lit(None).cast("double")

    aggs = []
    for i, f in enumerate(fields):
        aggs += [
            F.count(F.col(f.name)).alias(f"c{i}_filled"),
            F.min(F.col(f.name)).cast("string").alias(f"c{i}_min"),
            F.max(F.col(f.name)).cast("string").alias(f"c{i}_max"),
            stat(F.avg, f).alias(f"c{i}_avg"),
            stat(F.stddev_pop, f).alias(f"c{i}_pop"),
            stat(F.stddev_samp, f).alias(f"c{i}_samp"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("row_count"), *aggs)
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    *[
                        F.col(f"c{i}_{k}").alias(k) for k in ("filled", "min", "max", "avg", "pop", "samp")
                    ],
                )
                for i, f in enumerate(fields)
            ]
        )
    )
    wide = one.select("row_count", cells.alias("c")).select("row_count", "c.*")
    # numbers are counted once, for medians and distinct values
    found = []
    if numeric:
        counts = _value_counts(df, [c for c in names if c in numeric])
        chunks = ordered_chunks(counts.select("column_name", "number", F.col("count").alias("n")), "column_name", "number")
        wide = wide.join(exact_medians(chunks), "column_name", "left")
        found.append(chunks)
    else:
        wide = wide.withColumn("median", F.lit(None).cast("double"))
    if len(numeric) < len(names):
        found.append(_value_counts(df, [c for c in names if c not in numeric]))
    distinct = [part.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count")) for part in found]
    distinct = reduce(lambda a, b: a.unionAll(b), distinct)
    rows = F.col("row_count")
    return (
        wide.join(distinct, "column_name", "left")
        .fillna(0, subset=["distinct_count"])
        .select(
            F.lit(table_name).alias("table_name"),
            "column_name",
            "data_type",
            "row_count",
            (F.col("filled") / rows).alias("not_null_proportion"),
            (F.col("distinct_count") / rows).alias("distinct_proportion"),
            "distinct_count",
            (F.col("distinct_count") == rows).alias("is_unique"),
            "min",
            "max",
            "avg",
            "median",
            F.col("pop").alias("std_dev_population"),
            F.col("samp").alias("std_dev_sample"),
        )
    )


@dataclass(frozen=True)
class Rule:
    """``kind``: exists, type, not_null, unique (one or more columns) or at_least."""

    kind: str
    columns: tuple[str, ...]
    argument: object = None

    @property
    def label(self) -> str:
        return f"{self.kind}({','.join(self.columns)})"


def expect(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, violations) for every rule; row rules share one aggregate."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    fixed, row_rules, parts = [], [], []
    for rule in rules:
        missing = [c for c in rule.columns if c not in types]
        if rule.kind == "exists" or missing:
            fixed.append((rule.label, len(missing)))
        elif rule.kind == "type":
            fixed.append((rule.label, int(types[rule.columns[0]] != rule.argument)))
        elif rule.kind in ("not_null", "at_least"):
            c = F.col(rule.columns[0])
            bad = c.isNull() if rule.kind == "not_null" else c < F.lit(rule.argument)
            row_rules.append((rule.label, F.count_if(bad)))
        elif rule.kind == "unique":
            repeats = df.groupBy(*rule.columns).count().where("count > 1")
            parts.append(
                repeats.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(rule.label).alias("rule"), "violations")
            )
        else:
            raise ValueError(f"unknown rule {rule.kind}")
    if row_rules:
        one = df.agg(*[agg.alias(f"r{i}") for i, (_, agg) in enumerate(row_rules)])
        cells = [
            F.struct(F.lit(label).alias("rule"), F.col(f"r{i}").alias("violations"))
            for i, (label, _) in enumerate(row_rules)
        ]
        parts.append(one.select(F.explode(F.array(*cells)).alias("c")).select("c.*"))
    if fixed:
        parts.append(df.sparkSession.createDataFrame(fixed, "rule string, violations bigint"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def source_coverage(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """First time, last time and row count per source: name -> (table, time column)."""
    parts = [
        df.agg(F.min(ts).alias("first_tx"), F.max(ts).alias("last_tx"), F.count(F.lit(1)).alias("tx_count")).select(
            F.lit(name).alias("source"), "first_tx", "last_tx", "tx_count"
        )
        for name, (df, ts) in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def unmatched_chains(df: DataFrame, chains: DataFrame, source: str, target: str, chain_id: str = "chain_id") -> DataFrame:
    """Rows whose source or destination id is not a known chain."""
    known = chains.select(F.col(chain_id).alias("__id")).distinct()
    left = known.select(F.col("__id").alias("__s"))
    right = known.select(F.col("__id").alias("__t"))
    return (
        df.join(left, F.col(source) == F.col("__s"), "left")
        .join(right, F.col(target) == F.col("__t"), "left")
        .where(F.col("__s").isNull() | F.col("__t").isNull())
        .drop("__s", "__t")
    )
