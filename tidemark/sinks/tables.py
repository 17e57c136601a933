"""Published tables: load by mode, gated full refresh, keyed upsert.

A published table is a view over its current version; a version is an external Parquet table of the
Spark catalog with a name and a folder of its own. New content is written to a new folder and
registered as a new version first; then one ``CREATE OR REPLACE VIEW`` makes it the table. So a
reader sees the old rows or the new ones at any moment, and a write that fails anywhere leaves the
old ones. Parquet tables have no MERGE.

Versions are partitioned: by the table's own partition column, or by load, so that an append is one
more partition. A new version takes the entries of its predecessor over inside the catalog; only the
partitions that changed are dropped and registered by statements. Which folder holds what is known to
the catalog alone.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from tidemark.operators.merge import align_by_name, upsert_frame
from tidemark.operators.quality import GateFailed, require_keys, require_unique

How = Literal["replace", "append", "fail"]

# Values are kept in hexadecimal: Spark hides, in its listing, what looks like a URL or a secret.
PROPERTIES = "tidemark."
KEY_PROPERTY = "tidemark.key"
PARTITION_PROPERTY = "tidemark.partition"
PARTITION_EXPRESSION_PROPERTY = "tidemark.partition.expression"
VERSION_PROPERTY = "tidemark.version"
PATH_PROPERTY = "tidemark.path"
# The version of another table that a table's rows were made of.
SOURCE_PROPERTY = "tidemark.source"

# Staged rows lie beside a table's own folder.
STAGING = "__staging"

# Partitions that one catalog statement names; more take more statements.
PARTITIONS_PER_STATEMENT = 500

# Fixed value: what the catalog calls the partition of a NULL.
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"
# The partition column of versions of tables that declare none.
LOAD = "_load"
# The partition column of tables cut by a hash of their key.
BUCKET = "_bucket"


@dataclass(frozen=True)
class Definition:
    """Columns, unique key, and the partition column with its expression, if there is one."""

    schema: StructType
    key: list[str]
    partition: tuple[str, str] | None

    def shape(self, df: DataFrame) -> DataFrame:
        """The table's columns in the table's order and types, the partition column computed.

        A value that does not fit its column's type raises.
        """
        name = self.partition[0] if self.partition else None
        given = [f for f in self.schema.fields if f.name != name]
        aligned = align_by_name(df.drop(name) if name else df, [f.name for f in given])
        typed = aligned.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in given])
        return typed.withColumn(name, _partition_value(self.partition[1])) if name else typed


class Warehouse:
    """Tables under one root folder that all executors can reach.

    ``namespace`` prefixes the databases, so several runs can share a catalog.
    """

    def __init__(self, spark: SparkSession, root: str, namespace: str = "") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace
        self._databases: list[str] = []

    # Names and catalog entries

    def database(self, name: str) -> str:
        return f"{self.namespace}_{name}" if self.namespace else name

    def full_name(self, table: str) -> str:
        database, name = table.split(".")
        return f"{self.database(database)}.{name}"

    def create_database(self, name: str) -> None:
        """Create the database if it is absent."""
        full = self.database(name)
        path = f"{self.root}/db/{full}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {full} LOCATION {_literal(path)}")
        if full not in self._databases:
            self._databases.append(full)

    def release(self) -> None:
        """Forget the databases created here; table files stay where they are."""
        for full in self._databases:
            self.spark.sql(f"DROP DATABASE IF EXISTS {full} CASCADE")
        self._databases.clear()

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(table))

    def read(self, table: str) -> DataFrame:
        """The rows as of now: later writes publish other versions and do not change this frame."""
        return self._rows(self._properties(table)[VERSION_PROPERTY])

    snapshot = read

    def _rows(self, version: str) -> DataFrame:
        return self.spark.table(version).drop(LOAD)

    def location(self, table: str) -> str:
        """The folder of the current version."""
        return self._properties(table)[PATH_PROPERTY]

    def definition(self, table: str) -> Definition:
        found = self._properties(table)
        key = found[KEY_PROPERTY].split(",") if KEY_PROPERTY in found else []
        partition = None
        if PARTITION_PROPERTY in found:
            partition = found[PARTITION_PROPERTY], found[PARTITION_EXPRESSION_PROPERTY]
        return Definition(self._rows(found[VERSION_PROPERTY]).schema, key, partition)

    def key(self, table: str) -> list[str]:
        return self.definition(table).key

    def _properties(self, table: str) -> dict[str, str]:
        return self._properties_of(self.full_name(table))

    def _properties_of(self, full_name: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {full_name}").collect()
        return {r["key"]: bytes.fromhex(r["value"]).decode() for r in rows if r["key"].startswith(PROPERTIES)}

    def _new_version(self, table: str) -> str:
        database, name = table.split(".")
        return f"{self.root}/tables/{self.database(database)}/{name}/{uuid.uuid4().hex}"

    def _versions(self, table: str) -> list[str]:
        """Names of the registered versions, oldest first."""
        database, name = table.split(".")
        listed = self.spark.sql(f"SHOW TABLES IN {self.database(database)} LIKE '{name}__v*'").collect()
        prefix = f"{name}__v"
        names = [r["tableName"] for r in listed if r["tableName"].startswith(prefix)]
        return sorted(f"{self.database(database)}.{n}" for n in names)

    def _publish(
        self,
        table: str,
        schema: StructType,
        path: str,
        key: Sequence[str] = (),
        partition: tuple[str, str] | None = None,
        *,
        previous: str | None = None,
        changed: Sequence[str | None] = (),
        source: str | None = None,
    ) -> None:
        """Register the folder as a version and make it the table's content in one step.

        With a ``previous`` version its partitions are part of the new one, but those with a
        ``changed`` value, which are what was written below ``path``.
        """
        if any(f.name == LOAD for f in schema.fields):
            raise ValueError(f"{LOAD} is the name of a column of every version")
        database, name = table.split(".")
        self.create_database(database)
        version = f"{self.database(database)}.{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"
        columns = ", ".join(f"`{f.name}` {_type_name(f.dataType)}" for f in schema.fields)
        cut_by = partition[0] if partition else LOAD
        self.spark.sql(
            f"CREATE TABLE {version} ({columns}{'' if partition else f', {LOAD} string'}) USING parquet"
            f" PARTITIONED BY (`{cut_by}`)"
            f" LOCATION {_literal(path)} TBLPROPERTIES ({_listed({PATH_PROPERTY: path})})"
        )
        if previous:
            catalog = self._catalog()
            catalog.createPartitions(self._identifier(version), self._partitions(previous), False)
            for at in range(0, len(changed), PARTITIONS_PER_STATEMENT):
                specs = [
                    f"PARTITION (`{cut_by}`={'null' if v is None else _literal(v)})"
                    for v in changed[at : at + PARTITIONS_PER_STATEMENT]
                ]
                self.spark.sql(f"ALTER TABLE {version} DROP IF EXISTS {', '.join(specs)}")
        if partition:
            self.spark.sql(f"ALTER TABLE {version} RECOVER PARTITIONS")
        else:
            load = path.rpartition("/")[2]
            self.spark.sql(f"ALTER TABLE {version} ADD PARTITION ({LOAD}={_literal(load)}) LOCATION {_literal(path)}")
        properties = {VERSION_PROPERTY: version, PATH_PROPERTY: path}
        if source:
            properties[SOURCE_PROPERTY] = source
        if key:
            properties[KEY_PROPERTY] = ",".join(key)
        if partition:
            properties[PARTITION_PROPERTY] = partition[0]
            properties[PARTITION_EXPRESSION_PROPERTY] = partition[1]
        shown = ", ".join(f"`{f.name}`" for f in schema.fields)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.full_name(table)} TBLPROPERTIES ({_listed(properties)})"
            f" AS SELECT {shown} FROM {version}"
        )

    def _catalog(self):
        return self.spark._jsparkSession.sessionState().catalog()

    def _identifier(self, full_name: str):
        return self.spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(full_name)

    def _partitions(self, version: str):
        """The catalog's own entries; they are handed on as they are."""
        nothing = self.spark._jvm.scala.Option.empty()
        return self._catalog().listPartitions(self._identifier(version), nothing)

    def _partition_folders(self, version: str) -> Iterator[str]:
        return (folder for _, folder in self._partition_entries(version))

    def _file_system(self):
        jvm = self.spark.sparkContext._jvm
        path_of = jvm.org.apache.hadoop.fs.Path
        return path_of, path_of(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _remove(self, path: str) -> None:
        path_of, fs = self._file_system()
        fs.delete(path_of(path), True)

    def version(self, table: str) -> str:
        """The name of the current version."""
        return self._properties(table)[VERSION_PROPERTY]

    def source_version(self, table: str) -> str | None:
        """The source's version that ``replace_partitions`` noted last."""
        return self._properties(table).get(SOURCE_PROPERTY)

    def changed_partitions(self, table: str, since: str | None) -> list[str | None] | None:
        """Values of the partitions that were written, added or dropped since a version; None where
        that version is not known any more. Only catalog entries are compared."""
        if since is None or since not in self._versions(table):
            return None
        before, now = (dict(self._partition_entries(v)) for v in (since, self.version(table)))
        return [v for v in sorted(before.keys() | now.keys(), key=str) if before.get(v) != now.get(v)]

    def _partition_entries(self, version: str) -> Iterator[tuple[str | None, str]]:
        """Partition values and folders of a version."""
        entries = self._partitions(version).iterator()
        while entries.hasNext():
            entry = entries.next()
            value = entry.spec().values().head()
            yield (None if value in (None, NULL_VALUE) else value), entry.location().toString()

    def expire(self, table: str, keep: int = 2) -> int:
        """Forget all but the ``keep`` newest versions and delete the folders that none of those
        uses, staging folders included; returns how many folders went.

        Not to be run while the table is being written.
        """
        path_of, fs = self._file_system()
        column = (self.definition(table).partition or (None,))[0]
        versions = self._versions(table)
        for version in versions[:-keep]:
            self.spark.sql(f"DROP TABLE {version}")
        in_use: set[str] = set()
        for version in versions[-keep:]:
            in_use.add(self._properties_of(version)[PATH_PROPERTY])
            in_use.update(self._partition_folders(version))
        used = {fs.makeQualified(path_of(p)).toString() for p in in_use}
        holding = {u.rpartition("/")[0] for u in used}
        database, name = table.split(".")
        home = f"{self.root}/tables/{self.database(database)}/{name}"
        removed = 0

        def clean(pattern: str) -> None:
            nonlocal removed
            for status in fs.globStatus(path_of(pattern)) or []:
                path = status.getPath()
                if path.toString() not in used and path.toString() not in holding:
                    fs.delete(path, True)
                    removed += 1

        if column:
            clean(f"{home}/*/{column}=*")
        clean(f"{home}/*")
        clean(f"{home}{STAGING}/*")
        return removed

    # Definition

    def create_table(
        self,
        table: str,
        schema: StructType | str,
        key: Sequence[str] = (),
        partition: tuple[str, str] | None = None,
        buckets: int | None = None,
    ) -> None:
        """An empty typed table with a declared unique key, if it is absent.

        ``partition`` names one more column and gives the SQL expression that computes it from the
        key columns, so a key cannot sit in two partitions. Upserts then touch only the partitions
        they fall into. ``buckets`` is for keys without a date: the rows are cut by a hash of the key
        into so many parts, and an upsert of few keys writes few of them.
        """
        if self.exists(table):
            return
        if buckets:
            if partition or not key:
                raise ValueError("buckets need a key and no other partition")
            columns = ", ".join(f"`{k}`" for k in key)
            # Digits of one length, so that names and numbers have one order.
            partition = BUCKET, f"lpad(pmod(xxhash64({columns}), {buckets}), {len(str(buckets - 1))}, '0')"
        empty = self.spark.createDataFrame([], schema)
        if partition:
            name, expression = partition
            # Fails here if the expression uses anything but the key.
            empty.select(*key).select(F.expr(expression))
            empty = empty.withColumn(name, _partition_value(expression))
        path = self._new_version(table)
        self._write(empty, path, partition)
        self._publish(table, empty.schema, path, key, partition)

    def clone_schema(self, table: str, like: DataFrame, key: Sequence[str] = ()) -> None:
        """An empty table with the columns of ``like``, if it is absent."""
        self.create_table(table, StructType([_nullable(f) for f in like.schema.fields]), key)

    def drop(self, table: str, *, strict: bool = True) -> None:
        """Remove the table and its versions; a strict drop of an absent table raises."""
        present = self.exists(table)
        self.spark.sql(f"DROP VIEW {'' if strict else 'IF EXISTS '}{self.full_name(table)}")
        if present:
            for version in self._versions(table):
                self.spark.sql(f"DROP TABLE {version}")

    def truncate(self, table: str) -> None:
        """Remove all rows, keep the definition."""
        path, old = self._new_version(table), self.definition(table)
        self._write(self.read(table).limit(0), path, old.partition)
        self._publish(table, old.schema, path, old.key, old.partition)

    # Writes

    def _write(self, df: DataFrame, path: str, partition: tuple[str, str] | None) -> None:
        if partition:
            # Rows of one partition gather in few files; a partition past the advisory size is
            # split over several tasks at run time.
            df.hint("rebalance", partition[0]).write.partitionBy(partition[0]).parquet(path)
        else:
            df.write.parquet(path)

    def _write_version(
        self, df: DataFrame, table: str, partition: tuple[str, str] | None = None
    ) -> tuple[str, int]:
        """Write ``df`` to a new folder; returns the folder and the rows found in it.

        The count comes from the file footers, so it is what was written, without running ``df``
        again.
        """
        path = self._new_version(table)
        self._write(df, path, partition)
        return path, self.spark.read.schema(df.schema).parquet(path).count()

    def load(self, df: DataFrame, table: str, how: How = "replace") -> int:
        """Write a whole frame; returns the number of rows loaded.

        ``replace`` takes the frame's own columns and keeps a declared key and partition whose
        columns it has; ``append`` goes by the table's column names; ``fail`` refuses an existing
        table. A declared key stays unique: a frame that repeats one, or appends one that is there,
        raises before the table changes. NULL keys never conflict.
        """
        if how not in ("replace", "append", "fail"):
            raise ValueError(f"unknown mode {how!r}")
        present = self.exists(table)
        if present and how == "fail":
            raise ValueError(f"{table} exists")
        if present and how == "append":
            return self._append(df, table)
        key, partition = [], None
        if present:
            old = self.definition(table)
            if old.key and set(old.key) <= set(df.columns):
                key, partition = old.key, old.partition
        if partition:
            df = df.drop(partition[0]).withColumn(partition[0], _partition_value(partition[1]))
        path, rows = self._write_version(df, table, partition)
        self._require_unique(path, df.schema, key, f"rows for {table}")
        self._publish(table, df.schema, path, key, partition)
        return rows

    def _append(self, df: DataFrame, table: str) -> int:
        found, definition = self._properties(table), self.definition(table)
        key = definition.key
        # Written once; the key checks read the copy, and without a partition column it is the load.
        path, rows = self._write_version(definition.shape(df), table)
        staged = self.spark.read.schema(definition.schema).parquet(path)
        if key:
            require_unique(staged, key, f"rows for {table}")
            known = staged.join(self.read(table).select(*map(_quoted, key)), key, "left_semi")
            if not known.isEmpty():
                raise GateFailed(f"rows for {table} have keys that are there already")
        if definition.partition:
            self._merge_partitions(staged, table, definition, lambda old: old.unionByName(staged))
            self._remove(path)
        elif rows:
            self._publish(table, definition.schema, path, key, previous=found[VERSION_PROPERTY])
        return rows

    def _require_unique(self, path: str, schema: StructType, key: Sequence[str], what: str) -> None:
        if key:
            require_unique(self.spark.read.schema(schema).parquet(path), key, what)

    def refresh(self, staging: DataFrame, table: str) -> int:
        """Replace all rows with ``staging``, by column name.

        An empty staging, or one that repeats a declared key, raises and leaves the table as it is.
        Staging is computed once: the checks read the written folder, before it is published.
        """
        key, partition = [], None
        if self.exists(table):
            old = self.definition(table)
            staging, key, partition = old.shape(staging), old.key, old.partition
        path, rows = self._write_version(staging, table, partition)
        if rows == 0:
            raise GateFailed(f"staging for {table} is empty, the table was not touched")
        self._require_unique(path, staging.schema, key, f"staging for {table}")
        self._publish(table, staging.schema, path, key, partition)
        return rows

    def replace_partitions(
        self, df: DataFrame, table: str, values: Sequence[str | None] | None, source: str | None = None
    ) -> None:
        """Give the partitions with these values, or all, the rows of ``df``; the others stay where
        they are. ``df`` has rows of these partitions only; one that it has none of is dropped. ``source``
        is noted as the version of another table that the rows were made of."""
        definition = self.definition(table)
        if not definition.partition:
            raise ValueError(f"{table} has no partitions")
        previous = self.version(table)
        path, _ = self._write_version(definition.shape(df), table, definition.partition)
        self._require_unique(path, definition.schema, definition.key, f"rows for {table}")
        kept = {"previous": previous, "changed": values} if values is not None else {}
        self._publish(
            table, definition.schema, path, definition.key, definition.partition, source=source, **kept
        )

    def upsert(
        self,
        staging: DataFrame,
        table: str,
        keys: Sequence[str] = (),
        *,
        reject_null_keys: bool = False,
        copy: bool = True,
    ) -> None:
        """Update the rows whose key is staged and insert the rest.

        A key that is staged twice raises before the table changes. NULL keys never conflict and
        are inserted; where a batch may be replayed, ``reject_null_keys`` refuses them. Values are
        taken as staged, also NULL. ``copy=False`` is for a staging frame that is a plain read of
        written files, where computing it again costs less than a copy.

        A partitioned table has only the partitions that staging falls into read and written anew,
        whatever their number. An unpartitioned table is written anew.
        """
        target, definition = self.read(table), self.definition(table)
        keys = list(keys) or definition.key
        if not keys:
            raise ValueError(f"{table} has no declared key")
        # Into an empty table the staged copy is the new content, and no merge is written.
        first = copy and definition.partition is None and target.isEmpty()
        path = self._new_version(table)
        staged = definition.shape(staging)
        if copy:
            # Written once; the checks and the merge read the copy.
            aside = path if first else self._new_version(f"{table}{STAGING}")
            staged.write.parquet(aside)
            staged = self.spark.read.schema(definition.schema).parquet(aside)
        require_unique(staged, keys, f"staging for {table}")
        if reject_null_keys:
            require_keys(staged, keys, f"staging for {table}")
        if definition.partition:
            self._merge_partitions(staged, table, definition, lambda old: upsert_frame(old, staged, keys))
        else:
            if not first:
                upsert_frame(target, staged, keys).write.parquet(path)
            self._publish(table, definition.schema, path, definition.key)
        if copy and not first:
            self._remove(aside)

    def _merge_partitions(
        self,
        staged: DataFrame,
        table: str,
        definition: Definition,
        merged: Callable[[DataFrame], DataFrame],
    ) -> None:
        """Write the touched partitions anew, as ``merged`` makes them of their rows; the others stay
        where they are."""
        column = definition.partition[0]
        touched = staged.select(F.col(f"`{column}`").alias("value")).distinct()
        # Partition names, not rows: literals, so that the catalog prunes the scan.
        values = [r["value"] for r in touched.toLocalIterator()]
        if not values:
            return
        hit = F.col(f"`{column}`").isin([v for v in values if v is not None])
        if None in values:
            hit = hit | F.col(f"`{column}`").isNull()
        current = self.read(table).where(hit)
        # A dated delivery falls into new partitions as a rule: nothing to merge with.
        rows = staged if current.isEmpty() else merged(current)
        path, previous = self._new_version(table), self._properties(table)[VERSION_PROPERTY]
        self._write(rows, path, definition.partition)
        self._publish(
            table, definition.schema, path, definition.key, definition.partition, previous=previous, changed=values
        )


def _partition_value(expression: str) -> Column:
    """The value of the partition column. Folders cannot tell an empty text from a NULL."""
    return F.nullif(F.expr(expression).cast("string"), F.lit(""))


def _quoted(column: str) -> Column:
    return F.col(f"`{column}`")


def _type_name(kind: DataType) -> str:
    """The type in SQL, with the names of nested fields quoted."""
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"`{f.name}`: {_type_name(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, ArrayType):
        return f"array<{_type_name(kind.elementType)}>"
    if isinstance(kind, MapType):
        return f"map<{_type_name(kind.keyType)}, {_type_name(kind.valueType)}>"
    return kind.simpleString()


def _listed(properties: dict[str, str]) -> str:
    return ", ".join(f"{_literal(k)}={_literal(v.encode().hex())}" for k, v in properties.items())


def _literal(text: str) -> str:
    """``text`` as a SQL string."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _nullable(field):
    return type(field)(field.name, field.dataType, True, field.metadata)
