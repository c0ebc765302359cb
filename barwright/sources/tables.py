"""Catalog tables: creation, reads, snapshots and idempotent row replacement.

Layer tables are partitioned by ``date``. A rerun rewrites the dates it touches and leaves the table as it
was, so a job that died half way is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from barwright.operators.clean import latest_wins
from barwright.schemas import KEYS, conform
from barwright.sources.staging import stage


def create_schema(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def load(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)


def load_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    """The table, or None when it does not exist yet. Any other failure surfaces."""
    return spark.read.table(table) if spark.catalog.tableExists(table) else None


def snapshot(df: DataFrame, table: str, fmt: str = "parquet", order: str = "datetime") -> None:
    """Create or replace a table from a query; files are sorted, the table as a whole is not."""
    df.sortWithinPartitions(order).write.format(fmt).mode("overwrite").saveAsTable(table)


def _same_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the schema's form; columns that it does not name are an error."""
    unknown = [c for c in df.columns if c not in schema.fieldNames()]
    if unknown:
        raise ValueError(f"unknown columns: {unknown}")
    return conform(df, schema)


def append(df: DataFrame, table: str, schema: StructType, fmt: str = "parquet") -> None:
    _same_columns(df, schema).write.format(fmt).mode("append").saveAsTable(table)


def append_dated(df: DataFrame, table: str, schema: StructType, fmt: str = "parquet") -> None:
    """Append rows to a table that is partitioned by their ``date``."""
    rows = _by_date(_same_columns(df, schema))
    rows.write.format(fmt).partitionBy("date").mode("append").saveAsTable(table)


def replace_groups(df: DataFrame, table: str, schema: StructType, keys: list[str], fmt: str = "parquet") -> None:
    """Append rows in place of the stored ones that share their ``keys``; for small tables, which are rewritten."""
    spark = df.sparkSession
    fresh = stage(_same_columns(df, schema), "fresh")
    if not spark.catalog.tableExists(table):
        fresh.write.format(fmt).saveAsTable(table)
        return
    stored = spark.read.table(table)
    if stored.join(fresh.select(*keys), keys, "left_semi").isEmpty():
        fresh.write.format(fmt).mode("append").saveAsTable(table)
        return
    kept = stored.join(fresh.select(*keys).distinct(), keys, "left_anti").select(*fresh.columns)
    stage(kept.unionByName(fresh), "groups").write.format(fmt).mode("overwrite").saveAsTable(table)


def _dated(df: DataFrame, schema: StructType) -> DataFrame:
    dated = conform(df.drop("date"), schema)
    return dated.withColumn("date", F.to_date("datetime"))


_NUMBERS = ("tinyint", "smallint", "int", "bigint", "double")  # each holds the ones before it, doubles up to 2^53


def _wider(stored: DataType, incoming: DataType) -> bool:
    """Whether the column must take the incoming type on; an error if neither type holds the other."""
    a, b = stored.simpleString(), incoming.simpleString()
    if a == b:
        return False
    order = ("float", "double") if "float" in (a, b) else _NUMBERS
    if a not in order or b not in order:
        raise ValueError(f"a column of type {a} cannot take {b}")
    return order.index(b) > order.index(a)


def _provider(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Provider'").first()["data_type"]


def _types(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in spark.read.table(table).schema]


def _finish_widening(spark: SparkSession, table: str) -> None:
    """Fill the table from its widened copy, if there is one: now, or after a run that broke off."""
    copy = f"{table}__wide"
    if not spark.catalog.tableExists(copy):
        return
    wide = _types(spark, copy)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{name}` {kind}" for name, kind in wide)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING {_provider(spark, copy)} PARTITIONED BY (date)")
    if _types(spark, table) == wide:  # else the table was not dropped yet
        _overwrite_dates(_by_date(spark.read.table(copy)), table)
    spark.sql(f"DROP TABLE {copy}")


def _widen(incoming: DataFrame, table: str) -> None:
    """Rewrite the table, once, if a column comes with a wider type. The table goes when its copy is whole."""
    spark = incoming.sparkSession
    stored = spark.read.table(table)
    arriving = {f.name: f.dataType for f in incoming.schema}
    wide = {f.name: arriving[f.name] for f in stored.schema if f.name in arriving and _wider(f.dataType, arriving[f.name])}
    if not wide:
        return
    cast = stored.select(*[F.col(f"`{c}`").cast(wide[c]).alias(c) if c in wide else F.col(f"`{c}`") for c in stored.columns])
    _by_date(cast).write.format(_provider(spark, table)).partitionBy("date").saveAsTable(f"{table}__wide")
    spark.sql(f"DROP TABLE {table}")
    _finish_widening(spark, table)


def _evolve(incoming: DataFrame, table: str) -> DataFrame:
    """Add the columns that the table lacks to it, and those that ``incoming`` lacks to that, as nulls; of two number
    types of a column the wider one stays."""
    spark = incoming.sparkSession
    _widen(incoming, table)
    new = [f for f in incoming.schema if f.name not in spark.read.table(table).columns]
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        spark.catalog.refreshTable(table)
    stored = spark.read.table(table).schema
    return incoming.select(
        *[(F.col(f"`{f.name}`") if f.name in incoming.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored]
    )


def _by_date(df: DataFrame) -> DataFrame:
    """Rows of a date in neighbouring tasks: few files per date, and a hot date still spans tasks."""
    return df.repartitionByRange("date", "symbol", "datetime").sortWithinPartitions("date", "symbol", "datetime")


def _overwrite_dates(df: DataFrame, table: str) -> None:
    """Replace the partitions that ``df`` has rows for (insertInto heeds the setting, not a write option)."""
    conf, setting = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    previous = conf.get(setting)
    conf.set(setting, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(setting, previous)


def dates(df: DataFrame) -> list:
    """The distinct dates of a frame; there are as many as days, whatever the number of rows."""
    return [row["date"] for row in df.select("date").distinct().collect()]


def _differing_dates(stored: DataFrame, fresh: DataFrame) -> dict:
    """The dates on which one frame has a row more often than the other, and whether ``fresh`` has any row there."""
    signed = stored.withColumn("_n", F.lit(-1)).unionByName(fresh.withColumn("_n", F.lit(1)))
    rows = signed.groupBy(*stored.columns).agg(F.sum("_n").alias("_n"), F.max("_n").alias("_fresh"))
    days = rows.groupBy("date").agg(F.max(F.col("_n") != 0).alias("differs"), F.max(F.col("_fresh") > 0).alias("fresh"))
    return {r["date"]: r["fresh"] for r in days.filter("differs").collect()}


def unlike(fresh: DataFrame, table: str, schema: StructType, ignoring: list[str], keys: list[str] = KEYS) -> DataFrame:
    """The rows of ``fresh`` whose keys the table lacks or holds with other values, not counting some columns.

    Only the dates of ``fresh`` are read. A column that one side lacks counts as null there.
    """
    incoming = _dated(fresh, schema).drop(*ignoring)
    stored = fresh.sparkSession.read.table(table)
    held = stored.filter(F.col("date").isin(dates(incoming)))
    known = [c for c in stored.columns if c not in (*keys, *ignoring, "date")]
    held = held.select(*keys, F.struct(*[F.col(f"`{c}`") for c in known]).alias("_held"))
    names = dict.fromkeys([*known, *[c for c in incoming.columns if c not in (*keys, "date")]])
    equal = F.col("_held").isNotNull()
    for c in names:
        ours = F.col(f"`{c}`") if c in incoming.columns else F.lit(None)
        equal &= ours.eqNullSafe(F.col("_held").getField(c) if c in known else F.lit(None))
    return incoming.join(held, keys, "left").filter(~equal).drop("_held", "date")


def replace_rows(
    fresh: DataFrame,
    table: str,
    schema: StructType,
    keys: list[str] = KEYS,
    scope: DataFrame | None = None,
    version: str | None = None,
    fmt: str = "parquet",
    written: bool = False,
) -> None:
    """Put ``fresh`` rows into the table in place of the stored ones with equal keys.

    ``scope`` (symbol, start), a written frame, widens that: every stored row of the symbol at or past ``start`` goes too.
    With ``version``, stored and fresh rows compete and the highest version of a key stays, so a late
    arrival of older data does not win; fresh keys must be unique then. Only dates on which something differs are rewritten. Columns that
    the table does not have yet are added to it, and a column that comes with a wider number type is widened.
    ``written`` tells that ``fresh`` reads staged rows and needs no copy. The touched dates are read while their new
    files are written beside them; the write moves those into place when all are whole.
    """
    spark = fresh.sparkSession
    incoming = _dated(fresh, schema)
    _finish_widening(spark, table)
    if not spark.catalog.tableExists(table):
        _by_date(incoming).write.format(fmt).partitionBy("date").saveAsTable(table)
        return
    incoming = _evolve(incoming if written else stage(incoming, "incoming"), table)
    stored = spark.read.table(table)
    if scope is None:
        days = dict.fromkeys(dates(incoming), True)
    else:
        scope = scope.select("symbol", "start")
        first = scope.agg(F.to_date(F.min("start"))).first()[0]
        since = stored.filter(F.col("date") >= F.lit(first)).join(scope, "symbol")
        replaced = since.filter(F.col("datetime") >= F.col("start")).select(*incoming.columns)
        days = _differing_dates(replaced, incoming)
    if not days:
        return
    touched = stored.filter(F.col("date").isin(*days))  # literals: other partitions are not read
    arriving = incoming.filter(F.col("date").isin(*days))
    kept = touched
    if scope is not None:
        within = F.col("start").isNotNull() & (F.col("datetime") >= F.col("start"))
        kept = touched.join(scope, "symbol", "left").filter(~within).select(*incoming.columns)
    if version:
        # of equal versions the arriving row stays, so no two rows of a key tie
        rank = F.shiftleft(F.col(version), 1)
        both = kept.withColumn("_rank", rank).unionByName(arriving.withColumn("_rank", rank + 1)).drop("date")
        merged = latest_wins(both, "_rank", unique=True).withColumn("date", F.to_date("datetime"))
    else:
        merged = kept.join(arriving.select(*keys), keys, "left_anti").unionByName(arriving)
    without = [day for day, filled in days.items() if not filled]
    emptied = set(without) - set(dates(kept.filter(F.col("date").isin(without))) if without else [])
    _overwrite_dates(_by_date(merged.select(*incoming.columns)), table)
    for day in emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (date = DATE '{day}')")
