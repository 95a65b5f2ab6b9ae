"""Table lifecycle: create on first write, append, evolve, roll back, replace.

Session-catalog tables are Parquet; a table in any other configured catalog is
written through that catalog, which then also does evolution, deletes and
partition transforms natively.
"""

import re
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote as url_path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from terrace.functions.audit import AUDIT_COLUMNS
from terrace.operators.partitioning import (
    derived_columns, native_partitions, plain_partitions, source_columns, spread)
from terrace.workspace import move, remove, scratch

# Properties given to a table of an Iceberg-style catalog on creation.
TABLE_PROPERTIES = {
    "format-version": "2",
    "write.format.default": "parquet",
    "write.metadata.compression-codec": "gzip",
    "write.parquet.compression-codec": "zstd",
    "write.spark.accept-any-schema": "true",
    "write.target-file-size-bytes": "134217728",
}

# Table property that keeps the partition transforms of a plain table.
_LAYOUT = "terrace.partition_by"

# Table option that makes every overwrite of a plain table replace only the partitions
# it has rows for, whatever the session says.
_DYNAMIC = ("partitionOverwriteMode", "dynamic")

# Names of the tables through which bucketed files are written. No other table may have one.
_RESERVED = "_terrace_"

# Table property that names the stored intent of a replacement under way.
_INTENT = "terrace.replacement"

# Partitions that one replacement may switch: their list passes through the driver.
MAX_PARTITIONS = 100_000

_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_AS_TEXT = (*_INTEGERS, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType, T.DateType)
_EXACT_FLOAT = {T.FloatType: (T.ByteType, T.ShortType),
                T.DoubleType: (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)}


def quoted(*parts: str) -> str:
    """A multi-part identifier with every part back-quoted."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts if p)


def ensure_namespace(spark: SparkSession, namespace: str, catalog: str | None = None,
                     location: str | None = None) -> None:
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(catalog, namespace)}{where}")


def table_exists(spark: SparkSession, fqn: str) -> bool:
    """False for an unknown namespace too; any other failure is raised."""
    return spark.catalog.tableExists(fqn)


def name_parts(fqn: str) -> list[str]:
    """The parts of an identifier, quoted or not."""
    return [a.replace("``", "`") or b for a, b in re.findall(r"`((?:[^`]|``)+)`|([^.`]+)", fqn)]


def is_native(spark: SparkSession, fqn: str) -> bool:
    """Whether the table's catalog brings its own table format."""
    parts = name_parts(fqn)
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    return spark.conf.get(f"spark.sql.catalog.{catalog}", None) is not None


def partition_columns(spark: SparkSession, fqn: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(fqn) if c.isPartition]


def _layout_columns(spark: SparkSession, fqn: str) -> list[str]:
    """Columns that decide which file a row goes to; audit values are constant per write."""
    return [c.name for c in spark.catalog.listColumns(fqn)
            if (c.isPartition or c.isBucket) and c.name not in AUDIT_COLUMNS]


def lossless(given: T.DataType, held: T.DataType) -> bool:
    """Whether every value of one type can be stored in the other unchanged."""
    if given == held or isinstance(given, T.NullType):
        return True
    if isinstance(given, T.StructType) and isinstance(held, T.StructType):
        return ([f.name.lower() for f in given] == [f.name.lower() for f in held]
                and all(lossless(g.dataType, h.dataType) for g, h in zip(given, held)))
    if isinstance(given, T.ArrayType) and isinstance(held, T.ArrayType):
        return lossless(given.elementType, held.elementType)
    if isinstance(given, T.MapType) and isinstance(held, T.MapType):
        return lossless(given.keyType, held.keyType) and lossless(given.valueType, held.valueType)
    kind, target = type(given), type(held)
    if kind in _INTEGERS and target in _INTEGERS:
        return _INTEGERS.index(kind) <= _INTEGERS.index(target)
    if isinstance(held, T.DecimalType):
        whole = held.precision - held.scale
        if isinstance(given, T.DecimalType):
            return given.precision - given.scale <= whole and given.scale <= held.scale
        return kind in _DIGITS and _DIGITS[kind] <= whole
    if target is T.StringType:
        return kind in _AS_TEXT
    if kind is T.DateType:
        return target in (T.TimestampType, T.TimestampNTZType)
    return kind in _EXACT_FLOAT.get(target, ())


def _new_columns(df: DataFrame, held: T.StructType, fqn: str) -> list[T.StructField]:
    """Check types of shared columns; return the columns the table does not have yet."""
    known = {f.name.lower(): f for f in held}
    conflicts = [f"{f.name}: {f.dataType.simpleString()} into {known[f.name.lower()].dataType.simpleString()}"
                 for f in df.schema if f.name.lower() in known
                 and not lossless(f.dataType, known[f.name.lower()].dataType)]
    if conflicts:
        raise TypeError(f"{fqn} cannot hold these columns unchanged: {conflicts}")
    return [f for f in df.schema if f.name.lower() not in known]


def _nullable(kind: T.DataType) -> T.DataType:
    """The type with NULL allowed everywhere: another batch may lack any of it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_nullable(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(_nullable(kind.keyType), _nullable(kind.valueType))
    return kind


def add_columns(df: DataFrame, fqn: str, evolve: bool) -> None:
    """Refuse lossy types, and columns the table lacks unless they may be added."""
    spark = df.sparkSession
    added = _new_columns(df, spark.table(fqn).schema, fqn)
    if added and not evolve:
        raise ValueError(f"{fqn} has no column(s) {[f.name for f in added]}")
    if added:
        spark.sql(f"ALTER TABLE {fqn} ADD COLUMNS ({_nullable(T.StructType(added)).toDDL()})")


def append(df: DataFrame, namespace: str, table: str, catalog: str | None = None,
           partition_by: Sequence[str] = (), properties: Mapping[str, str] | None = None,
           evolve: bool = False, replay_of: str | None = None,
           observe: tuple[Observation, Sequence[Column]] | None = None) -> str:
    """Append, creating the table on its first write. Never replaces existing rows.

    With ``evolve`` unknown columns are added first (older rows read NULL); without
    it they are an error. Columns the frame lacks become NULL. Partitioning and
    properties apply at creation only. ``replay_of`` names the batch this frame is
    the whole of: partitions already holding that batch are rewritten, not doubled.
    ``observe`` collects metrics in the stage that writes, after any shuffle, where
    work repeated for a lost executor is counted once.
    """
    if table.lower().startswith(_RESERVED):
        raise ValueError(f"table names that start with {_RESERVED!r} are reserved: {table}")
    spark = df.sparkSession
    fqn = quoted(catalog, namespace, table)
    ensure_namespace(spark, namespace, catalog)
    if is_native(spark, fqn):
        watched = df.observe(observe[0], *observe[1]) if observe else df
        _append_native(watched, fqn, partition_by, properties, evolve, replay_of)
        return fqn

    restore(spark, fqn)
    if not table_exists(spark, fqn):
        rows = spread(_with_derived(df, partition_by), _write_keys(partition_by))
        rows = rows.observe(observe[0], *observe[1]) if observe else rows
        writer = rows.writeTo(fqn).using("parquet").option("compression", "zstd").option(*_DYNAMIC)
        layout = {_LAYOUT: "; ".join(partition_by)} if derived_columns(partition_by) else {}
        for key, value in {**layout, **(properties or {})}.items():
            writer = writer.tableProperty(key, value)
        if partition_by:
            writer = writer.partitionedBy(*plain_partitions(partition_by))
        writer.create()
        return fqn

    df = with_partitions(df, fqn)
    add_columns(df, fqn, evolve)
    rows = spread(df, [k for k in _layout_columns(spark, fqn) if k in df.columns])
    rows = rows.observe(observe[0], *observe[1]) if observe else rows
    if replay_of is not None:
        if "_batch_id" in partition_columns(spark, fqn):
            _overwrite(rows, fqn)
            return fqn
        rollback_batch(spark, fqn, replay_of)
    spark.sql(f"INSERT INTO {fqn} BY NAME SELECT * FROM {{rows}}", rows=rows)
    return fqn


def _with_derived(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    derived = derived_columns(partition_by)
    return df.withColumns(derived) if derived else df


def with_partitions(df: DataFrame, fqn: str) -> DataFrame:
    """The frame with the derived partition columns of a plain table.

    The transforms the table was created with are kept in it, so later writers need
    not repeat them.
    """
    spark = df.sparkSession
    if is_native(spark, fqn) or not partition_columns(spark, fqn):
        return df
    held = _properties(spark, fqn)
    return _with_derived(df, held[_LAYOUT].split("; ")) if _LAYOUT in held else df


def partition_sources(spark: SparkSession, fqn: str) -> set[str]:
    """The columns that alone decide a row's partition in a plain table."""
    held = _properties(spark, fqn)
    derived = source_columns(held[_LAYOUT].split("; ")) if _LAYOUT in held else {}
    return {derived.get(c, c) for c in partition_columns(spark, fqn)}


def _write_keys(partition_by: Sequence[str]) -> list[str]:
    names = [next(iter(derived_columns([entry])), re.sub(r".*[(, ](\w+)\)$", r"\1", entry))
             for entry in partition_by]
    return [n for n in names if n not in AUDIT_COLUMNS]


def _append_native(df, fqn, partition_by, properties, evolve, replay_of):
    spark = df.sparkSession
    if not table_exists(spark, fqn):
        layout = ", ".join(native_partitions(partition_by))
        stated = ", ".join(f"'{k}' = '{v}'" for k, v in {**TABLE_PROPERTIES, **(properties or {})}.items())
        spark.sql(f"CREATE TABLE {fqn} ({_nullable(df.schema).toDDL()})"
                  + (f" PARTITIONED BY ({layout})" if layout else "") + f" TBLPROPERTIES ({stated})")
    added = _new_columns(df, spark.table(fqn).schema, fqn)
    if added and not evolve:
        raise ValueError(f"{fqn} has no column(s) {[f.name for f in added]}")
    writer = df.writeTo(fqn).option("mergeSchema", str(evolve).lower())
    if replay_of is None:
        writer.append()
    else:
        writer.overwrite(F.col("_batch_id") == replay_of)


def evolve_and_append(df: DataFrame, namespace: str, table: str, **options) -> str:
    return append(df, namespace, table, evolve=True, **options)


def _overwrite(df: DataFrame, fqn: str) -> None:
    """Overwrite the partitions the frame has rows for."""
    spark = df.sparkSession
    option = _properties(spark, fqn).get(f"option.{_DYNAMIC[0]}", spark.conf.get("spark.sql.sources.partitionOverwriteMode"))
    if option.lower() != _DYNAMIC[1]:
        raise ValueError(f"{fqn} was not created here: set spark.sql.sources.partitionOverwriteMode to dynamic "
                         "for the session, or its overwrites would remove all other partitions")
    held = spark.table(fqn).schema
    have = {c.lower() for c in df.columns}
    rows = df.select(*[F.col(quoted(f.name)) if f.name.lower() in have
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in held])
    rows.write.mode("overwrite").insertInto(fqn)


def _properties(spark: SparkSession, fqn: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {fqn}").collect()}


def overwrite_partitions(df: DataFrame, fqn: str) -> None:
    """Replace exactly the partitions the frame has rows for; the others stay."""
    spark = df.sparkSession
    if is_native(spark, fqn):
        df.writeTo(fqn).overwritePartitions()
        return
    restore(spark, fqn)
    keys = partition_columns(spark, fqn)
    if not keys:
        raise ValueError(f"{fqn} is not partitioned")
    df = with_partitions(df, fqn)
    add_columns(df, fqn, evolve=False)
    _overwrite(spread(df, keys), fqn)


def write_partitioned(df: DataFrame, namespace: str, table: str, partition_by: Sequence[str],
                      catalog: str | None = None, evolve: bool = False) -> str:
    """A write that must be partitioned; a rerun replaces the partitions it computed."""
    if not partition_by:
        raise ValueError(f"{namespace}.{table} needs a partitioning")
    spark, fqn = df.sparkSession, quoted(catalog, namespace, table)
    if not is_native(spark, fqn):
        restore(spark, fqn)
    if not table_exists(spark, fqn):
        return append(df, namespace, table, catalog, partition_by)
    if not is_native(spark, fqn):
        df = with_partitions(df, fqn)
        add_columns(df, fqn, evolve)
    overwrite_partitions(df, fqn)
    return fqn


def batch_rows(df: DataFrame, batch_id: str) -> DataFrame:
    return df.where(F.col("_batch_id") == batch_id)


def rollback_batch(spark: SparkSession, fqn: str, batch_id: str) -> None:
    """Remove one batch; every other row stays. An unknown batch changes nothing.

    Metadata only when the table is partitioned by the batch.
    """
    restore(spark, fqn)
    if not is_native(spark, fqn) and "_batch_id" in partition_columns(spark, fqn):
        drop_partitions(spark, fqn, [{"_batch_id": batch_id}])
    else:
        delete_rows(spark, fqn, f"_batch_id = {literal(batch_id)}")


def drop_partitions(spark: SparkSession, fqn: str, partitions: Sequence[Mapping]) -> None:
    """Drop partitions given as ``{column: value}``, leading columns are enough."""
    for partition in partitions:
        spec = ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in partition.items())
        spark.sql(f"ALTER TABLE {fqn} DROP IF EXISTS PARTITION ({spec})")


def literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def delete_rows(spark: SparkSession, fqn: str, condition: str) -> None:
    """Remove the rows that meet an SQL condition; without such rows nothing is written.

    A partitioned table rewrites only the partitions that hold such rows.
    """
    if is_native(spark, fqn):
        spark.sql(f"DELETE FROM {fqn} WHERE {condition}")
        return
    restore(spark, fqn)
    table, keys = spark.table(fqn), partition_columns(spark, fqn)
    gone = F.coalesce(F.expr(condition), F.lit(False))
    if not keys:
        if not table.where(gone).isEmpty():
            replace_table(table.where(~gone), fqn)
    else:
        touched = [r.asDict() for r in bounded(table.where(gone).select(*keys).distinct(), fqn)]
        if touched:
            replace_partitions(in_partitions(table, touched).where(~gone), fqn, touched)


def in_partitions(table: DataFrame, partitions: Sequence[Mapping]) -> DataFrame:
    """Rows of the given partitions; the lists prune the scan, the semi join is exact."""
    spark, keys = table.sparkSession, list(partitions[0])
    listed = spark.createDataFrame([tuple(p[k] for k in keys) for p in partitions],
                                   T.StructType([table.schema[k] for k in keys]))
    exact = None
    for k in keys:
        values = [p[k] for p in partitions if p[k] is not None]
        wanted = F.col(quoted(k)).isin(values)
        if len(values) < len(partitions):
            wanted = wanted | F.col(quoted(k)).isNull()
        table = table.where(wanted)
        same = table[k].eqNullSafe(listed[k])
        exact = same if exact is None else exact & same
    return table.join(listed, exact, "left_semi")


def replace_partitions(df: DataFrame, fqn: str, partitions: Sequence[Mapping]) -> None:
    """Make the frame, which may read the table, the whole contents of these partitions."""
    spark = df.sparkSession
    _refuse_repaired(spark, fqn)
    _switch_partitions(df, fqn, partitions)


def replace_table(df: DataFrame, fqn: str) -> None:
    """Make the frame, which may read the table, its whole contents."""
    spark = df.sparkSession
    if is_native(spark, fqn):
        df.writeTo(fqn).replace()
        return
    _refuse_repaired(spark, fqn)
    keys = partition_columns(spark, fqn)
    if keys:
        held = spark.table(fqn).select(*keys).distinct()
        _switch_partitions(df, fqn, [r.asDict() for r in bounded(held, fqn)])
        return
    old = location(spark, fqn)
    head, _, last = old.rpartition("/")
    new = f"{head}/{last.split('--')[0]}--{uuid.uuid4().hex[:12]}"
    _write_files(df, fqn, new)
    _commit(spark, fqn, [(None, new)], [], [old])


def bounded(rows: DataFrame, fqn: str) -> list:
    """At most one row per partition, collected; more than ``MAX_PARTITIONS`` are refused."""
    found = rows.limit(MAX_PARTITIONS + 1).collect()
    if len(found) > MAX_PARTITIONS:
        raise ValueError(f"{fqn}: more than {MAX_PARTITIONS} partitions at once; partition by hash(n, key), "
                         "which bounds their number")
    return found


def _refuse_repaired(spark: SparkSession, fqn: str) -> None:
    """A frame computed from a half-replaced table must not become its contents."""
    if restore(spark, fqn):
        raise RuntimeError(f"an earlier replacement of {fqn} had stopped half-way; it is completed "
                           "now, so compute the new rows again")


def _switch_partitions(df: DataFrame, fqn: str, partitions: Sequence[Mapping]) -> None:
    """Write the new files into a fresh folder of the table and point its partitions there."""
    spark = df.sparkSession
    keys, table = partition_columns(spark, fqn), spark.table(fqn)
    fresh = f"{location(spark, fqn)}/_{uuid.uuid4().hex[:12]}"
    _write_files(df, fqn, fresh)
    written = spark.read.schema(table.schema).parquet(fresh)
    new = {tuple(r[:-1]): url_path(r[-1]) for r in bounded(_folders(written, keys), fqn)}
    old = bounded(_folders(in_partitions(table, partitions), keys), fqn) if partitions else []
    listed = dict.fromkeys([tuple(p[k] for k in keys) for p in partitions])
    spec = {values: ", ".join(f"{quoted(k)} = {literal(v)}" for k, v in zip(keys, values))
            for values in {**listed, **new}}
    _commit(spark, fqn, [(spec[v], folder) for v, folder in new.items()],
            [spec[v] for v in listed if v not in new], [url_path(r[-1]) for r in old])


def _folders(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The partitions that have rows, with the folder of each (as a URL)."""
    path = rows.metadataColumn("_metadata").getField("file_path")
    folder = F.regexp_replace(path, "/[^/]*$", "")
    return rows.select(*keys, folder.alias("_folder")).groupBy(*keys).agg(F.max("_folder").alias("_folder"))


def location(spark: SparkSession, fqn: str) -> str:
    shown = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {fqn}").collect()}
    return shown["Location"].rstrip("/")


def _write_files(df: DataFrame, fqn: str, folder: str) -> None:
    """Write the rows into a folder as the table lays its files out."""
    spark = df.sparkSession
    held, keys, buckets = spark.table(fqn).schema, partition_columns(spark, fqn), stored_buckets(spark, fqn)
    have = {c.lower() for c in df.columns}
    rows = df.select(*[(F.col(quoted(f.name)) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in held])
    writer = spread(rows, _layout_columns(spark, fqn)).write.option("compression", "zstd")
    if keys:
        writer = writer.partitionBy(*keys)
    if not buckets:
        writer.parquet(folder)
        return
    # Buckets can only be written through a table: one of its own, whose files stay when it goes.
    through = quoted(*name_parts(fqn)[:-1], _RESERVED + uuid.uuid4().hex[:12])
    count, names = buckets
    writer.format("parquet").option("path", folder).bucketBy(count, *names).saveAsTable(through)
    spark.sql(f"DROP TABLE {through}")


_INTENT_ROW = ("switched array<struct<spec: string, folder: string>>, dropped array<string>, old array<string>, "
               "moved array<struct<file: string, place: string>>")


def commit_moves(spark: SparkSession, fqn: str, moved: list[tuple[str, str]], old: list[str]) -> None:
    """Move files that were written aside into the table and remove old ones, as one replacement."""
    _commit(spark, fqn, [], [], old, moved)
    spark.catalog.refreshTable(fqn)


def _commit(spark: SparkSession, fqn: str, switched: list, dropped: list, old: list, moved: list = ()) -> None:
    """Record the whole intent as one row, let the table name it, and carry it out.

    Before the table names it nothing has changed; afterwards ``restore`` carries it out again,
    as often as it takes. No row is copied and nothing is renamed.
    """
    path = scratch(spark, "intent")
    spark.createDataFrame([(switched, dropped, old, list(moved))], _INTENT_ROW).write.parquet(path)
    _state(spark, f"ALTER TABLE {fqn} SET TBLPROPERTIES ('{_INTENT}' = {literal(path)})")
    _carry_out(spark, fqn, path)


def _carry_out(spark: SparkSession, fqn: str, path: str) -> None:
    intent = spark.read.schema(_INTENT_ROW).parquet(path).first()
    for spec, folder in intent["switched"]:
        if spec is None:
            _state(spark, f"ALTER TABLE {fqn} SET LOCATION {literal(folder)}")
        else:
            _state(spark, f"ALTER TABLE {fqn} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {literal(folder)}")
            _state(spark, f"ALTER TABLE {fqn} PARTITION ({spec}) SET LOCATION {literal(folder)}")
    for spec in intent["dropped"]:
        _state(spark, f"ALTER TABLE {fqn} DROP IF EXISTS PARTITION ({spec})")
    for file, place in intent["moved"]:
        move(spark, file, place)
    used = {folder for _, folder in intent["switched"]}
    for folder in intent["old"]:
        if folder not in used:
            remove(spark, folder)
    _state(spark, f"ALTER TABLE {fqn} UNSET TBLPROPERTIES IF EXISTS ('{_INTENT}')")
    remove(spark, path)


def _state(spark: SparkSession, statement: str) -> None:
    spark.sql(statement)


def restore(spark: SparkSession, fqn: str) -> bool:
    """Complete a replacement that stopped half-way; says whether there was one.

    The table itself names the intent, so any spelling of its name finds it.
    """
    if not table_exists(spark, fqn) or is_native(spark, fqn):
        return False
    path = _properties(spark, fqn).get(_INTENT)
    if path:
        _carry_out(spark, fqn, path)
    return bool(path)


def stored_buckets(spark: SparkSession, fqn: str) -> tuple | None:
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {fqn}").collect()}
    count = int(detail.get("Num Buckets") or 0)
    names = re.findall(r"`([^`]+)`", detail.get("Bucket Columns") or "")
    return (count, names) if count > 0 else None


def list_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """``SHOW SCHEMAS`` as a frame."""
    return spark.sql("SHOW NAMESPACES" + (f" IN {quoted(catalog)}" if catalog else ""))


def list_tables(spark: SparkSession, namespace: str, catalog: str | None = None) -> DataFrame:
    """``SHOW TABLES`` as a frame."""
    shown = spark.sql(f"SHOW TABLES IN {quoted(catalog, namespace)}")
    return shown.where(~F.col("isTemporary") & ~F.startswith("tableName", F.lit(_RESERVED))).select("namespace", F.col("tableName").alias("table"))


def preview(df: DataFrame, order_by: Sequence, rows: int = 10) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order_by).limit(rows)
