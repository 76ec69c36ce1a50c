"""Writers for tables, files and namespaces.

A table or folder is replaced only by a complete one: rows are written to a fresh place first, and then the name is switched to
it. Whatever fails before the switch leaves the former content as it was.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlens.sources import filesystem
from remitlens.sources.readers import as_json_arrays
from remitlens.sources.snapshots import counted_write

#: Table properties: the folder of the rows before the last replacement, and the rows that a write counted in a folder.
FORMER_FOLDER, COUNTED_FOLDER, COUNTED_ROWS = "remitlens.former", "remitlens.counted.folder", "remitlens.counted.rows"


@dataclass(frozen=True)
class Written:
    """A written table, and its rows as the write counted them."""

    table: DataFrame
    rows: int


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog tells of a table, by name."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    marker = [i for i, row in enumerate(rows) if row["col_name"].startswith("# Detailed")]
    return {row["col_name"]: row["data_type"] for row in rows[marker[0] :]} if marker else {}


def _folder(spark: SparkSession, table: str) -> str:
    return _facts(spark, table)["Location"]


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set_properties(spark: SparkSession, table: str, values: dict[str, str]) -> None:
    listed = ", ".join(f"'{key}' = '{value}'" for key, value in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({listed})")


def _same_layout(spark: SparkSession, table: str, other: str) -> bool:
    """Equal columns and buckets: then the rows of one can be those of the other."""
    layouts = []
    for name in (table, other):
        facts = _facts(spark, name)
        columns = [(field.name, field.dataType.simpleString()) for field in spark.table(name).schema.fields]
        layouts.append((columns, facts.get("Num Buckets"), facts.get("Bucket Columns"), facts.get("Provider")))
    return layouts[0] == layouts[1]


def _drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def publish_table(df: DataFrame, table: str, bucket_by: str | None = None, buckets: int | None = None) -> Written:
    """Create or replace a catalog table once its rows are complete.

    The rows are written as a table of another name in a folder of their own. A table of the same columns is then pointed to that
    folder, which is one change of the catalog; for other columns, or a table that is new, the written one takes over the name
    (a failure in between gives the former table its name back). Running queries go on reading the former rows, which
    are removed by the replacement after the next; so do other sessions that have read the table, until they refresh it (Spark
    keeps what it knows of a table per session). With buckets, joins and groupings on the bucket column read the
    table without a shuffle.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    database, _, name = table.rpartition(".")
    prefix = f"{database}." if database else ""
    where = spark.sql(f"DESCRIBE DATABASE {database or spark.catalog.currentDatabase()}").collect()
    home = next(row["info_value"] for row in where if row["info_name"] == "Location")
    draft, folder = f"{prefix}{name}__{mark}", f"{home.rstrip('/')}/{name}-{mark}"

    def write(rows: DataFrame) -> None:
        writer = rows.write.mode("errorifexists").format("parquet").option("path", folder)
        if bucket_by and buckets:
            writer = writer.bucketBy(buckets, bucket_by)
        writer.saveAsTable(draft)

    try:
        rows = counted_write(df, write)
    except Exception:
        _drop(spark, draft)
        filesystem.remove(spark, folder)
        raise
    rows = spark.table(draft).count() if rows is None else rows
    # The count goes with the folder: it says nothing once the table points elsewhere.
    counted = {COUNTED_FOLDER: f"{name}-{mark}", COUNTED_ROWS: str(rows)}
    if not spark.catalog.tableExists(table):
        _set_properties(spark, draft, counted)
        spark.sql(f"ALTER TABLE {draft} RENAME TO {table}")
        return Written(spark.table(table), rows)
    former, older = _folder(spark, table), _properties(spark, table).get(FORMER_FOLDER)
    if _same_layout(spark, table, draft) and _facts(spark, table).get("Type") == "EXTERNAL":
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        _set_properties(spark, table, {**counted, FORMER_FOLDER: former})
        _drop(spark, draft)
    else:
        aside = f"{prefix}{name}__was_{mark}"
        _set_properties(spark, draft, {**counted, FORMER_FOLDER: former})
        spark.sql(f"ALTER TABLE {table} RENAME TO {aside}")
        try:
            spark.sql(f"ALTER TABLE {draft} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {table}")
            _drop(spark, draft)
            filesystem.remove(spark, folder)
            raise
        _drop(spark, aside)
    if older and older not in (former, _folder(spark, table)):
        filesystem.remove(spark, older)
    spark.catalog.refreshTable(table)
    return Written(spark.table(table), rows)


def replace_table(
    df: DataFrame, table: str, bucket_by: str | None = None, buckets: int | None = None
) -> DataFrame:
    """``publish_table``, and the table it gives."""
    return publish_table(df, table, bucket_by, buckets).table


def known_rows(spark: SparkSession, table: str) -> int | None:
    """The rows of a table as its writes counted them; None if the table was not written here, or a write to it broke off."""
    properties = _properties(spark, table)
    if not properties.get(COUNTED_ROWS) or properties[COUNTED_FOLDER] != _folder(spark, table).rsplit("/", 1)[-1]:
        return None
    return int(properties[COUNTED_ROWS])


def add_rows(df: DataFrame, table: str) -> Written:
    """Add rows to a catalog table, which is created if it does not exist; the rows are those of the table afterwards."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return publish_table(df, table)
    before = known_rows(spark, table)
    # Unknown until the write has ended: its rows may be there without having been counted.
    _set_properties(spark, table, {COUNTED_FOLDER: _folder(spark, table).rsplit("/", 1)[-1], COUNTED_ROWS: ""})
    added = counted_write(df, lambda rows: rows.write.mode("append").format("parquet").saveAsTable(table))
    total = spark.table(table).count() if before is None or added is None else before + added
    _set_properties(spark, table, {COUNTED_ROWS: str(total)})
    return Written(spark.table(table), total)


#: Partition column of tables whose loads may be repeated.
LOAD_ID = "load_id"


def append_load(df: DataFrame, table: str, load_id: str) -> Written:
    """Add the rows of a load to a table that is partitioned by load; the same load again replaces its own rows and no others.

    The rows are those of the load. A load that is cut short leaves the partition as it was, until the job commits.
    """
    spark = df.sparkSession
    rows = df.withColumn(LOAD_ID, F.lit(load_id))
    if not spark.catalog.tableExists(table):
        # Empty at first, so that a first load that fails leaves a table without rows and may be repeated like any other.
        rows.limit(0).write.format("parquet").partitionBy(LOAD_ID).saveAsTable(table)
    expected = [field.name for field in spark.table(table).schema.fields]
    if expected != rows.columns:
        raise ValueError(f"{table} has the columns {expected}, the load has {rows.columns}")

    folder = _folder(spark, table)

    def write(out: DataFrame) -> None:
        # Dynamic: partitions are replaced as the job commits, and only those that it wrote.
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_ID).parquet(folder)

    added = counted_write(rows, write)
    if added is None:
        added = rows.count()
    quoted = load_id.replace("\\", "\\\\").replace("'", "\\'")
    step = "ADD IF NOT EXISTS" if added else "DROP IF EXISTS"  # a load without rows writes no partition
    spark.sql(f"ALTER TABLE {table} {step} PARTITION ({LOAD_ID} = '{quoted}')")
    spark.catalog.refreshTable(table)
    return Written(spark.table(table), added)


def append_table(df: DataFrame, table: str) -> DataFrame:
    """``add_rows``, and the table it gives."""
    return add_rows(df, table).table


def replace_files(df: DataFrame, path: str) -> DataFrame:
    """Overwrite a parquet folder once the new one is complete; loading the same input again gives the same content.

    Two renames make the switch. A call that is cut short between them leaves the former folder under its second name, and the next
    call puts it back first; ``SnapshotStore`` switches in one step.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    draft, aside = f"{path}.new-{uuid.uuid4().hex}", f"{path}.was"
    if filesystem.exists(spark, aside):
        if filesystem.exists(spark, path):
            filesystem.remove(spark, aside)
        else:
            filesystem.rename(spark, aside, path)
    try:
        df.write.mode("errorifexists").parquet(draft)
    except Exception:
        filesystem.remove(spark, draft)
        raise
    if filesystem.exists(spark, path):
        filesystem.rename(spark, path, aside)
    filesystem.rename(spark, draft, path)
    filesystem.remove(spark, aside)
    return spark.read.schema(df.schema).parquet(path)


def append_files(df: DataFrame, path: str) -> DataFrame:
    """Append to a parquet folder; loading the same input again repeats its rows."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. ``single_file`` is for results of bounded size, such as a top-k ledger."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def land_json_arrays(df: DataFrame, path: str, records_per_array: int, one_array_per_file: bool) -> None:
    """Write JSON arrays, either one per file (readable only as whole documents) or one per line (splittable)."""
    writer = as_json_arrays(df, records_per_array).write.mode("overwrite")
    if one_array_per_file:
        writer = writer.option("maxRecordsPerFile", 1)
    writer.text(path)
