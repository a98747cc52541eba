"""Finding tables by name pattern, and typed CSV files."""

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import quoted

# Catalog table types and the names they are reported under.
_TABLE_TYPES = {
    "BASE TABLE": "table",
    "MANAGED": "table",
    "FOREIGN": "external",
    "EXTERNAL TABLE": "external",
    "EXTERNAL": "external",
    "MATERIALIZED VIEW": "materializedview",
    "TEMPORARY": "view",
}


@dataclass(frozen=True)
class Relation:
    schema: str
    name: str
    kind: str
    catalog: str = ""

    @property
    def full_name(self) -> str:
        """The quoted name, as Spark takes it."""
        return ".".join(quoted(p) for p in (self.catalog, self.schema, self.name) if p)


def table_kind(raw: str) -> str:
    return _TABLE_TYPES.get(raw.upper(), raw.lower())


def like(pattern: str, text: str) -> bool:
    """SQL LIKE without regard to case: % is any text, _ any one character."""
    parts = {"%": ".*", "_": "."}
    regex = "".join(parts.get(ch, re.escape(ch)) for ch in pattern)
    return re.fullmatch(regex, text, re.IGNORECASE | re.DOTALL) is not None


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "", database: str = ""
) -> list[Relation]:
    """Tables and views whose schema and name match; sorted, empty when none do.

    ``database`` names another catalog than the current one. Temporary views have
    an empty schema name. The patterns go into the listing, so only the tables
    that it finds are looked up for their kind.
    """
    of = f" IN {quoted(database)}" if database else ""
    prefix = f"{quoted(database)}." if database else ""
    found = set()
    for (schema,) in spark.sql(f"SHOW SCHEMAS{of}").select("namespace").collect():
        if not like(schema_pattern, schema):
            continue
        listed = spark.sql(f"SHOW TABLES IN {prefix}{quoted(schema)} LIKE {_listing(table_pattern)}")
        for row in listed.where("NOT isTemporary").collect():
            if like(table_pattern, row.tableName) and not (exclude and like(exclude, row.tableName)):
                name = f"{prefix}{quoted(schema)}.{quoted(row.tableName)}"
                kind = table_kind(spark.catalog.getTable(name).tableType)
                found.add(Relation(schema, row.tableName, kind, database))
    if not database and like(schema_pattern, ""):
        for row in spark.sql(f"SHOW VIEWS LIKE {_listing(table_pattern)}").where("isTemporary").collect():
            if like(table_pattern, row.viewName) and not (exclude and like(exclude, row.viewName)):
                found.add(Relation("", row.viewName, table_kind("TEMPORARY")))
    return sorted(found, key=lambda r: (r.schema, r.name))


def _listing(pattern: str) -> str:
    """A superset of the pattern in the catalog's own terms: * is any text, | separates."""
    text = re.sub(r"[^\w]+|_", "*", pattern)
    return "'" + (re.sub(r"\*+", "*", text) or "*") + "'"


def relations_by_prefix(
    spark: SparkSession, schema: str, prefix: str, exclude: str = "", database: str = ""
) -> list[Relation]:
    """As by pattern, with ``prefix%``; '_' in the prefix still matches any character."""
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude, database)


def read_relations(spark: SparkSession, relations: list[Relation]) -> dict[str, DataFrame]:
    """The found tables by name, ready for ``union_relations``."""
    return {".".join(p for p in (r.catalog, r.schema, r.name) if p): spark.table(r.full_name) for r in relations}


def read_typed_csv(
    spark: SparkSession, path, schema: str, overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV with a header line and a declared schema; ``overrides`` change single types.

    Columns go by their names in the header, whatever their order; undeclared ones
    are left out, a declared one that is missing raises, and so does a file whose
    header is not that of the first. Empty cells are null. Nothing is inferred:
    the first line is looked at for the names, and the files are read once.
    """
    columns = [part.strip().split(None, 1) for part in re.split(r",(?![^(<]*[)>])", schema)]
    types = {**{name: kind for name, kind in columns}, **(overrides or {})}
    header = spark.read.csv(path, header=True).columns
    known = {name.lower(): name for name in types}
    missing = [name for name in types if name.lower() not in {h.lower() for h in header}]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    ddl = ", ".join(f"{quoted(h)} {types[known[h.lower()]] if h.lower() in known else 'string'}" for h in header)
    rows = spark.read.csv(path, schema=ddl, header=True, enforceSchema=False, nullValue="", emptyValue="")
    return rows.select(*[F.col(quoted(name)).alias(name) for name, _ in columns])
