"""Sources with declared schemas: scans that prune and push down, and drift that is reported instead of cast away.

A declaration names the columns a reader may rely on, their types and the stored names behind them. ``load`` compares
it with the stored schema before it reads: wider types are narrowed only where no value can change, other types and
absent columns raise ``SchemaDrift``. Conditions are put on the stored columns ahead of any cast, so they reach the
parquet reader, and only declared (or asked) columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaDrift(ValueError):
    """The stored schema can't give what the declaration promises."""


@dataclass(frozen=True)
class Source:
    table: str
    ddl: str
    date: str | None = "date"
    stored: dict[str, str] = field(default_factory=dict)  # declared name -> stored name, where they differ
    optional: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    def at(self, name: str) -> str:
        return self.stored.get(name, name)


# Stored type -> declared types it can be given as without changing a value.
_ORDER = ["byte", "short", "integer", "long"]
_SAFE = {k: set(_ORDER[i:]) | {"string"} for i, k in enumerate(_ORDER)} | {"float": {"float", "double"}, "date": {"date", "timestamp", "timestamp_ntz"}, "timestamp": {"timestamp", "date"}, "timestamp_ntz": {"timestamp_ntz", "date"}}
for _k in ("byte", "short", "integer"):
    _SAFE[_k] |= {"double"}


def status(stored: T.DataType, declared: T.DataType) -> str:
    """ok, widened (a cast keeps every value; a day of a timestamp counts as such) or retyped."""
    if stored == declared:
        return "ok"
    if isinstance(stored, T.DecimalType) and isinstance(declared, T.DecimalType):
        fits = declared.scale >= stored.scale and declared.precision - declared.scale >= stored.precision - stored.scale
        return "widened" if fits else "retyped"
    return "widened" if declared.typeName() in _SAFE.get(stored.typeName(), ()) else "retyped"


def compare(source: Source, stored: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(field, status, declared type, stored type): ok, widened, retyped, missing, absent (optional) or novel."""
    have = {f.name: f.dataType for f in stored.fields}
    rows = []
    for f in source.schema.fields:
        kind = have.get(source.at(f.name))
        what = status(kind, f.dataType) if kind is not None else "absent" if f.name in source.optional else "missing"
        rows.append((f.name, what, f.dataType.simpleString(), kind.simpleString() if kind is not None else None))
    used = {source.at(f.name) for f in source.schema.fields}
    return rows + [(n, "novel", None, k.simpleString()) for n, k in have.items() if n not in used]


def load(spark: SparkSession, root: str, source: Source, since: str | None = None, until: str | None = None, entities: list | None = None, columns: list[str] | None = None) -> DataFrame:
    """The declared columns (or those asked for) of rows dated in [since, until] of the entities asked for."""
    raw = spark.read.parquet(f"{root}/{source.table}.parquet")
    bad = [f"{n} is {what} ({got or 'absent'} for {want})" for n, what, want, got in compare(source, raw.schema) if what in ("retyped", "missing")]
    if bad:
        raise SchemaDrift(f"{source.table}: {'; '.join(bad)}")
    if (since or until) and source.date is None:
        raise ValueError(f"{source.table} has no date")
    if since or until:
        day, kind = F.col(source.at(source.date)), raw.schema[source.at(source.date)].dataType
        if since:
            raw = raw.filter(day >= F.lit(since).cast(kind))
        if until:  # the whole of the last day where days have hours
            raw = raw.filter(day < F.date_add(F.lit(until).cast("date"), 1).cast(kind))
    if entities is not None:
        raw = raw.filter(F.col(source.at("entity")).isin(entities))
    have = set(raw.columns)
    fields = [f for f in source.schema.fields if columns is None or f.name in columns]
    unknown = set(columns or ()) - {f.name for f in fields}
    if unknown:
        raise ValueError(f"not declared: {', '.join(sorted(unknown))}")
    return raw.select(*[(F.col(source.at(f.name)) if source.at(f.name) in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def drift(spark: SparkSession, root: str, sources: dict[str, Source]) -> DataFrame:
    """One row per source and field: status, both types and the rows that carry a value (one scan a source)."""
    parts = []
    for name, s in sources.items():
        raw = spark.read.parquet(f"{root}/{s.table}.parquet")
        found = compare(s, raw.schema)
        at = {n: n if what == "novel" else s.at(n) for n, what, _, _ in found}
        one = raw.agg(*[(F.count(F.col(at[n])) if got else F.lit(0).cast("long")).alias(f"c{i}") for i, (n, _, _, got) in enumerate(found)])
        rows = [F.struct(F.lit(n).alias("field"), F.lit(what).alias("status"), F.lit(want).cast("string").alias("declared"), F.lit(got).cast("string").alias("stored"), F.col(f"c{i}").alias("filled")) for i, (n, what, want, got) in enumerate(found)]
        parts.append(one.select(F.lit(name).alias("source"), F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)
