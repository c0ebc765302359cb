"""The batch jobs: ticks -> bronze -> silver -> gold -> model -> serving tables.

Bronze reads ticks from each symbol's high-water mark less an overlap; the marks are a table of their own. (``ingest``
reads new files instead, without an overlap.) Only bars whose values differ from the stored ones are loaded. A load
reserves its number, writes its rows under it and publishes it; the later layers trust published numbers only, so it
does not matter when they run or whether a load breaks off: its rows count with the next load that is published.

The later layers replace their rows from the first bar that bronze has changed since their last run, as far as
the layer before them has got: gold that runs ahead of silver waits for it. A run may be repeated, and once
every layer has run after the last load, in whatever order and however often before, the tables are
what a full recompute would leave. One load at a time; the other layers may run beside it.

Instants reach the driver as microseconds, so its time zone does not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright import schemas
from barwright.operators.bars import resample
from barwright.operators.chunks import DAY, HOUR, cut_size
from barwright.operators.clean import silver
from barwright.operators.features import LOOK_BACK, complete_cases, features, with_pending
from barwright.operators.incremental import gold_with_context, last_rows_before, silver_from
from barwright.operators.marks import (
    BACKFILL,
    OVERLAP,
    backfill_range,
    from_micros,
    high_water_mark,
    instant,
    micros,
    overlap_range,
)
from barwright.operators.split import train_test, train_validation_test
from barwright.plans.model import fit_grid, next_step
from barwright.plans.serving import serving_shift
from barwright.session import pin_utc
from barwright.sources import tables
from barwright.sources.staging import scratch, stage

NEAR = timedelta(days=7)  # history tried first when a run looks back
UPSTREAM = {"silver": "bronze", "gold": "silver", "serving": "gold"}
RESERVED = "reserved"


@dataclass(frozen=True)
class Layers:
    """Table names of one database, the storage format and the length of a bar."""

    database: str
    fmt: str = "parquet"
    step: timedelta = HOUR

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    @property
    def interval(self) -> str:
        return f"{self.step // timedelta(microseconds=1)} microseconds"

    def cut(self, stored: DataFrame) -> int | None:
        """Chunk size for a stored layer, from its partition dates alone."""
        return cut_size(stored, self.step, at="date", resolution=DAY)


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """UTC throughout, and no intermediate files left behind."""
    pin_utc(spark)
    with scratch(spark):
        yield


def _bar_start(at: int, layers: Layers) -> int:
    """The start of the bar that an instant falls into, both in microseconds."""
    return at - at % (layers.step // timedelta(microseconds=1))


def _marks(spark: SparkSession, layers: Layers) -> DataFrame | None:
    """(symbol, max_dt) of what bronze holds; of a bronze table older than its marks, from that table."""
    marks = tables.load_or_none(spark, layers.name("marks"))
    if marks is None and spark.catalog.tableExists(layers.name("bronze")):
        marks = stage(high_water_mark(tables.load(spark, layers.name("bronze"))), "marks")
    return marks


def _last_load(spark: SparkSession, layers: Layers) -> int | None:
    """The earliest instant whose ticks the last run may have missed: its ``as_of`` less the overlap."""
    loads = tables.load_or_none(spark, layers.name("loads"))
    return loads.agg(F.unix_micros(F.max("as_of") - F.lit(OVERLAP))).first()[0] if loads is not None else None


def _fetch(
    ticks: DataFrame, layers: Layers, as_of: datetime, since: datetime | None, symbols: DataFrame | None
) -> DataFrame:
    """The bars a run has to load: 720 days for new symbols, else from the mark less the overlap."""
    spark = ticks.sparkSession
    oldest = instant(as_of) - F.lit(BACKFILL)
    history = ticks.filter(F.col("ts") >= oldest)
    marks = _marks(spark, layers)
    low = marks.agg(F.unix_micros(F.min("max_dt") - F.lit(OVERLAP)).alias("low")).first()["low"] if marks is not None else None
    if low is None:  # no table yet, or one without rows
        return backfill_range(resample(history, layers.interval), as_of)
    known_until = _last_load(spark, layers) if since is None else micros(since)
    if known_until is not None:
        low = max(low, _bar_start(known_until, layers))
    fresh = ticks.filter(F.col("ts") >= from_micros(low))  # a literal: reaches the scan
    bars = overlap_range(resample(fresh, layers.interval), marks)
    present = history if symbols is None else symbols  # else one narrow column of the range
    unseen = stage(present.select("symbol").distinct().join(marks, "symbol", "left_anti"), "unseen")
    if not unseen.isEmpty():
        whole = history.join(unseen, "symbol", "left_semi")
        first_load = backfill_range(resample(whole, layers.interval), as_of)
        bars = bars.join(unseen, "symbol", "left_anti").unionByName(first_load)
    return bars


def _records(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """The highest load number that is reserved, published (bronze), or processed by each later layer."""
    progress = tables.load_or_none(spark, layers.name("progress"))
    if progress is None:
        return {}
    return {r["layer"]: r["seq"] for r in progress.groupBy("layer").agg(F.max("ingest_seq").alias("seq")).collect()}


def _is_open(records: dict[str, int]) -> bool:
    """A load has reserved a number and not published it: it runs, or it broke off."""
    return records.get(RESERVED, -1) > records.get("bronze", -1)


def _free_number(spark: SparkSession, layers: Layers, records: dict[str, int], wanted: int | None) -> int:
    """``wanted`` if no later number is published, else one that no load has used."""
    used = max(records.get("bronze", -1), records.get(RESERVED, -1))
    if not records and spark.catalog.tableExists(layers.name("bronze")):  # a table from before the records
        stored = tables.load(spark, layers.name("bronze")).agg(F.max("ingest_seq")).first()[0]
        used = -1 if stored is None else stored
    return wanted if wanted is not None and wanted > records.get("bronze", -1) and wanted >= used else used + 1


def reserve(spark: SparkSession, layers: Layers, seq: int | None = None, records: dict[str, int] | None = None) -> int:
    """A number for a load, known to be in use from now on. One load runs at a time, so it may have read ``records``."""
    number = _free_number(spark, layers, _records(spark, layers) if records is None else records, seq)
    _record(spark, layers, RESERVED, number)
    return number


def publish(spark: SparkSession, layers: Layers, seq: int) -> None:
    """From now on the rows of the load, and of earlier ones that broke off, count for the later layers."""
    _record(spark, layers, "bronze", seq)


def write_bars(bars: DataFrame, layers: Layers, seq: int) -> None:
    """Upsert bars into bronze under a reserved number, and bring the marks up. ``bars`` are staged unless the table is new."""
    spark = bars.sparkSession
    bronze = layers.name("bronze")
    first = not spark.catalog.tableExists(bronze)
    numbered = bars.withColumn("ingest_seq", F.lit(seq).cast("long"))
    tables.replace_rows(numbered, bronze, schemas.BRONZE, version="ingest_seq", fmt=layers.fmt, written=not first)
    if first:
        tables.snapshot(high_water_mark(tables.load(spark, bronze)), layers.name("marks"), layers.fmt, "symbol")
        return
    marks = high_water_mark(bars).unionByName(_marks(spark, layers).select("symbol", "max_dt"))
    newest = stage(marks.groupBy("symbol").agg(F.max("max_dt").alias("max_dt")), "marks")
    tables.snapshot(newest, layers.name("marks"), layers.fmt, "symbol")


def store_bars(bars: DataFrame, layers: Layers, seq: int | None = None) -> bool:
    """Upsert the bars that bronze does not hold yet with these values; whether there were any.

    They get the number ``seq``, by default the next free one, also if a load of that number or a later one is
    published already. Bars that are equal to the stored ones keep their number, so no later layer looks at them.
    """
    spark = bars.sparkSession
    with scratch(spark):
        if not spark.catalog.tableExists(layers.name("bronze")):
            number = reserve(spark, layers, seq)
            write_bars(bars, layers, number)
            publish(spark, layers, number)
            return True
        changed = stage(tables.unlike(stage(bars, "bars"), layers.name("bronze"), schemas.BRONZE, ["ingest_seq"]), "changed")
        news = not changed.isEmpty()
        records = _records(spark, layers)
        if not news and not _is_open(records):
            return False
        number = reserve(spark, layers, seq, records)
        if news:
            write_bars(changed, layers, number)
        publish(spark, layers, number)
        return news


def run_bronze(
    ticks: DataFrame,
    layers: Layers,
    as_of: datetime,
    seq: int | None = None,
    since: datetime | None = None,
    symbols: DataFrame | None = None,
) -> None:
    """Load the bars that are new or may have changed.

    Every symbol is read from its own mark less the overlap, but ticks older than ``since`` are taken to be
    loaded already: by default those older than the last run's ``as_of`` less the overlap. Pass an earlier
    instant to pick up ticks that came later than that. A symbol that is not loaded yet is read over
    its 720 days whatever the age of its ticks; without ``symbols``, the symbols to load, they are found by reading
    the symbol column of that range.
    """
    spark = ticks.sparkSession
    with job(spark):
        tables.create_schema(spark, layers.database)
        store_bars(_fetch(ticks, layers, as_of, since, symbols), layers, seq)
        done = _one_row(spark).select(instant(as_of).alias("as_of"))
        tables.append(done, layers.name("loads"), schemas.LOADS, layers.fmt)


@dataclass(frozen=True)
class Changes:
    """What a layer has not seen yet: (symbol, start) per changed symbol, the earliest start in microseconds, and
    how far the layer will have got."""

    starts: DataFrame
    earliest: int
    seq: int

    @property
    def horizon(self) -> Column:
        return from_micros(self.earliest - NEAR // timedelta(microseconds=1))

    def marks(self) -> DataFrame:
        return self.starts.withColumnRenamed("start", "max_dt")

    def part(self, stored: DataFrame) -> DataFrame:
        """The stored rows from the starts on; older partitions are not read."""
        dated = stored.filter(F.col("date") >= F.to_date(from_micros(self.earliest)))
        return dated.join(self.starts, "symbol").filter(F.col("datetime") >= F.col("start")).drop("start")


def _changes(spark: SparkSession, layers: Layers, layer: str) -> Changes | None:
    """Bronze rows that the layer before this one has processed and this one has not; None if there are none.

    The filter skips files by their statistics. A row that a later load has replaced meanwhile comes with that
    load, once the layer before has processed it.
    """
    records = _records(spark, layers)
    reached, seen = records.get(UPSTREAM[layer]), records.get(layer)
    if reached is None or (seen is not None and seen >= reached):
        return None
    bronze = tables.load(spark, layers.name("bronze")).filter(F.col("ingest_seq") <= reached)
    if seen is not None:
        bronze = bronze.filter(F.col("ingest_seq") > seen)
    starts = stage(bronze.groupBy("symbol").agg(F.min("datetime").alias("start")), "changes")
    earliest = starts.agg(F.unix_micros(F.min("start"))).first()[0]
    if earliest is None:  # loads without changes
        _record(spark, layers, layer, reached)
        return None
    return Changes(starts, earliest, reached)


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1)


def _record(spark: SparkSession, layers: Layers, layer: str, seq: int) -> None:
    done = _one_row(spark).select(F.lit(layer).alias("layer"), F.lit(seq).cast("long").alias("ingest_seq"))
    tables.append(done, layers.name("progress"), schemas.PROGRESS, layers.fmt)


def run_silver(spark: SparkSession, layers: Layers) -> None:
    """Recompute silver from each changed symbol's first changed bar on."""
    with job(spark):
        changes = _changes(spark, layers, "silver")
        if changes is None:
            return
        bronze = tables.load(spark, layers.name("bronze"))
        stored = tables.load_or_none(spark, layers.name("silver"))
        rows = layers.cut(bronze)
        if stored is None:
            fresh, scope = silver(bronze, layers.step, rows), None
        else:
            carry = stored.select("symbol", "datetime", "volume", "date")
            before = last_rows_before(carry, changes.marks(), 1, changes.horizon, inclusive=True)
            fresh = silver_from(changes.part(bronze), before, layers.step, rows)
            scope = changes.starts
        tables.replace_rows(fresh, layers.name("silver"), schemas.SILVER, scope=scope, fmt=layers.fmt)
        _record(spark, layers, "silver", changes.seq)


def run_gold(spark: SparkSession, layers: Layers) -> None:
    """Recompute gold from the row before each changed symbol's first changed bar on.

    Pending rows are stored too: forecasts start from them, training leaves them out.
    """
    with job(spark):
        changes = _changes(spark, layers, "gold")
        if changes is None:
            return
        bars = tables.load(spark, layers.name("silver"))
        stored = tables.load_or_none(spark, layers.name("gold"))
        rows = layers.cut(bars)
        if stored is None:
            fresh, scope = with_pending(features(bars, layers.step, rows)), None
        else:
            context = last_rows_before(bars, changes.marks(), LOOK_BACK + 1, changes.horizon, inclusive=True)
            fresh = gold_with_context(changes.part(bars), context, 1, layers.step, rows)
            scope = changes.starts
        tables.replace_rows(fresh, layers.name("gold"), schemas.GOLD, scope=scope, fmt=layers.fmt)
        _record(spark, layers, "gold", changes.seq)


def run_training(
    spark: SparkSession,
    layers: Layers,
    run_id: str,
    model_path: str | None = None,
    validation: float | None = None,
    common_cut: bool = False,
) -> PipelineModel:
    """Fit the grid, record every run, store the forecast of each symbol's next bar. Repeating a ``run_id``
    replaces its rows.

    The best run is the one with the lowest error on the test rows, or, given a ``validation`` share, on
    that last part of the training rows. With ``common_cut`` training and test rows are parted at one instant for all
    symbols instead of per symbol.
    """
    with job(spark):
        gold = tables.load(spark, layers.name("gold"))
        rows = layers.cut(gold)
        usable = complete_cases(gold.drop("date"))
        if validation:
            train, scored, _ = train_validation_test(usable, validation, step=layers.step, rows=rows, common=common_cut)
        else:
            train, scored = train_test(usable, step=layers.step, rows=rows, common=common_cut)
        grid = fit_grid(stage(train, "train"), stage(scored, "scored"))
        labelled = grid.runs.withColumns({"run_id": F.lit(run_id), "run_by": F.current_user()})
        recorded = stage(labelled, "runs")
        tables.replace_groups(recorded, layers.name("model_runs"), schemas.MODEL_RUNS, ["run_id"], layers.fmt)
        model = replace(grid, runs=recorded).best()
        if model_path:
            model.write().overwrite().save(model_path)
        forecast = next_step(model, gold.drop("date")).withColumn("run_id", F.lit(run_id))
        tables.replace_rows(
            forecast,
            layers.name("predictions"),
            schemas.PREDICTIONS,
            keys=[*schemas.KEYS, "run_id"],
            fmt=layers.fmt,
        )
        return model


def run_serving(spark: SparkSession, layers: Layers) -> None:
    """Bring the serving table up to gold, from the row before each symbol's first changed bar on."""
    with job(spark):
        changes = _changes(spark, layers, "serving")
        if changes is None:
            return
        gold = tables.load(spark, layers.name("gold")).select("symbol", "datetime", "close", "target_price", "date")
        if not spark.catalog.tableExists(layers.name("serving")):
            rows, scope = gold, None
        else:
            before = last_rows_before(gold, changes.marks(), 1, changes.horizon, inclusive=True).drop("_back")
            rows = changes.part(gold).unionByName(before)
            earlier = before.select("symbol", F.col("datetime").alias("_before"))
            reach = changes.starts.join(earlier, "symbol", "left")
            scope = stage(reach.select("symbol", F.coalesce("_before", "start").alias("start")), "scope")
        fresh = serving_shift(rows)
        tables.replace_rows(fresh, layers.name("serving"), schemas.SERVING, scope=scope, fmt=layers.fmt)
        _record(spark, layers, "serving", changes.seq)


def run_layers(
    ticks: DataFrame,
    layers: Layers,
    as_of: datetime,
    seq: int | None = None,
    since: datetime | None = None,
    symbols: DataFrame | None = None,
) -> None:
    """One scheduled run of the data layers."""
    spark = ticks.sparkSession
    run_bronze(ticks, layers, as_of, seq, since, symbols)
    follow(spark, layers)


def follow(spark: SparkSession, layers: Layers) -> None:
    """Bring the layers after bronze up to what is published."""
    records = _records(spark, layers)
    if any(records.get(layer, -1) < records.get("bronze", -1) for layer in UPSTREAM):
        run_silver(spark, layers)
        run_gold(spark, layers)
        run_serving(spark, layers)
