import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barwright.operators.bars import resample
from barwright.operators.clean import silver
from barwright.operators.features import features, with_pending
from barwright.plans.layers import (
    Layers, run_bronze, run_gold, run_layers, run_serving, run_silver, run_training, store_bars,
)
from barwright.plans.serving import serving_shift
from barwright.schemas import BARS, BRONZE, GOLD, SILVER, TICKS
from barwright.sources import tables
from barwright.sources.readers import with_size
from barwright.sources.staging import shared_dir
from conftest import at, same_rows, series


def make_ticks(spark, hours=60, seed=5, symbols=("a", "b")):
    rng = random.Random(seed)
    rows = []
    for symbol in symbols:
        for i in range(hours * 4):
            if rng.random() < 0.7:
                when = at(i / 4) + timedelta(seconds=rng.randrange(900))
                rows.append((symbol, when, len(rows), round(rng.uniform(20, 60), 2)))
    return with_size(spark.createDataFrame(rows, TICKS), F.col("price") >= 40)


def known(ticks, as_of):
    return ticks.filter(F.col("ts") < F.lit(as_of.isoformat()).cast("timestamp"))


def check_layers(spark, layers, ticks):
    bars = resample(ticks)
    stored = {n: spark.table(layers.name(n)).drop("date") for n in ("bronze", "silver", "gold")}
    assert same_rows(stored["bronze"].select(*BARS.fieldNames()), bars)
    full = silver(bars)
    assert same_rows(stored["silver"].select(*SILVER.fieldNames()), full)
    gold = with_pending(features(full))
    assert same_rows(stored["gold"].select(*GOLD.fieldNames()), gold)
    assert same_rows(spark.table(layers.name("serving")).drop("date"), serving_shift(gold))


def test_runs_equal_a_recompute(spark):
    """Runs in the middle of an hour see partial bars, which the next run's overlap repairs."""
    layers = Layers("runs")
    ticks = make_ticks(spark).cache()
    for seq, hour in enumerate([30.4, 31.2, 60]):
        seen = known(ticks, at(hour))
        run_layers(seen, layers, at(hour), seq)
        check_layers(spark, layers, seen)
    before = [spark.table(layers.name(n)).collect() for n in ("silver", "gold", "serving")]
    run_layers(ticks, layers, at(60))
    after = [spark.table(layers.name(n)).collect() for n in ("silver", "gold", "serving")]
    assert [sorted(map(str, b)) for b in before] == [sorted(map(str, a)) for a in after]


def test_bounded_scan_and_no_leftovers(spark):
    """With ``since`` older ticks are not read; the bar it falls into is still whole."""
    layers = Layers("bounded")
    ticks = make_ticks(spark)
    idle = make_ticks(spark, hours=2, symbols=("idle",))
    run_layers(known(ticks, at(40)).unionByName(idle), layers, at(40), 0)
    files = set(Path(shared_dir(spark).removeprefix("file:")).iterdir())
    recent = ticks.filter(F.col("ts") >= F.lit(at(37).isoformat()).cast("timestamp"))
    run_layers(recent, layers, at(60), 1, since=at(37.8))
    check_layers(spark, layers, ticks.unionByName(idle))
    assert set(Path(shared_dir(spark).removeprefix("file:")).iterdir()) == files


def test_minute_bars(spark):
    layers = Layers("minutes", step=timedelta(minutes=1))
    ticks = make_ticks(spark, hours=10)
    for seq, hour in enumerate([6, 10]):
        run_layers(known(ticks, at(hour)), layers, at(hour), seq)
    bars = resample(ticks, "1 minute")
    full = silver(bars, timedelta(minutes=1), 100)
    assert same_rows(spark.table("minutes.silver").select(*SILVER.fieldNames()), full)
    gold = with_pending(features(full, timedelta(minutes=1), 100))
    assert same_rows(spark.table("minutes.gold").select(*GOLD.fieldNames()), gold)


def test_first_run_without_ticks(spark):
    layers = Layers("late_start")
    ticks = make_ticks(spark, hours=20)
    run_layers(ticks.limit(0), layers, at(0))
    run_layers(known(ticks, at(12)), layers, at(12))
    run_layers(ticks, layers, at(20))
    check_layers(spark, layers, ticks)


def test_new_symbol_is_loaded_from_its_beginning(spark):
    layers = Layers("newcomer")
    run_layers(known(make_ticks(spark, symbols=("a",)), at(40)), layers, at(40), 0)
    both = make_ticks(spark, symbols=("a", "b"))
    run_layers(both, layers, at(60), 1)
    check_layers(spark, layers, both)


def test_sparse_and_late_bars(spark, make_bars):
    """Look-back beyond the near history, a late bar, a bar that loses its close, an idle symbol."""
    layers = Layers("sparse")
    tables.create_schema(spark, layers.database)
    rows = [
        *series([float(i % 9 + i) for i in range(1, 41)], [i % 3 for i in range(40)], "rare", [50 * i for i in range(40)]),
        *series([float(i % 7 + i) for i in range(1, 41)], [i % 2 for i in range(40)], "idle"),
    ]
    late = [r for r in rows if r["hour"] in (10, 1000)]
    batches = [
        [r for r in rows[:30] + rows[40:] if r not in late],
        rows[30:40],
        late,
        [{"symbol": "rare", "hour": 1950, "close": None}, {"symbol": "rare", "hour": 500, "close": 3.5, "volume": 0}],
    ]
    current = {}
    for seq, batch in enumerate(batches):
        store_bars(make_bars(batch), layers, seq)
        run_silver(spark, layers)
        run_gold(spark, layers)
        run_serving(spark, layers)
        current |= {(r["symbol"], r["hour"]): r for r in batch}
        full = silver(make_bars(list(current.values())), rows=16)
        assert same_rows(spark.table("sparse.silver").select(*SILVER.fieldNames()), full)
        gold = with_pending(features(full, rows=16))
        assert same_rows(spark.table("sparse.gold").select(*GOLD.fieldNames()), gold)
        assert same_rows(spark.table("sparse.serving").drop("date"), serving_shift(gold))


def test_training_appends_runs_and_upserts_forecasts(spark, tmp_path):
    from pyspark.ml import PipelineModel

    layers = Layers("training")
    run_layers(make_ticks(spark, hours=90), layers, at(90), 0)
    model = run_training(spark, layers, "r1", str(tmp_path / "model"))
    run_training(spark, layers, "r2", validation=0.2)
    runs = spark.table(layers.name("model_runs"))
    assert runs.groupBy("run_id").count().collect()[0]["count"] == 9 and runs.count() == 18
    forecasts = spark.table(layers.name("predictions"))
    assert forecasts.count() == 4
    newest = spark.table(layers.name("silver")).agg(F.max("datetime")).first()[0]
    assert forecasts.filter("run_id = 'r1'").agg(F.max("datetime")).first()[0] == newest
    again = PipelineModel.load(str(tmp_path / "model"))
    assert again.stages[-1].coefficients == model.stages[-1].coefficients


def frame(spark, rows):
    return spark.createDataFrame([(s, at(h), 1.0, 1.0, 1.0, c, 1) for s, h, c in rows], BARS)


def closes(spark, table):
    return {(r.symbol, r.datetime): r.close for r in spark.table(table).collect()}


def test_replace_rows_is_idempotent(spark):
    tables.create_schema(spark, "writers")
    first = frame(spark, [("a", 0, 1.0), ("a", 30, 2.0), ("b", 30, 3.0)])
    second = frame(spark, [("a", 30, 9.0), ("a", 60, 4.0)])
    for _ in range(2):
        tables.replace_rows(first, "writers.t", BARS)
    assert len(closes(spark, "writers.t")) == 3
    for _ in range(2):
        tables.replace_rows(second, "writers.t", BARS)
        assert closes(spark, "writers.t") == {
            ("a", at(0)): 1.0, ("a", at(30)): 9.0, ("b", at(30)): 3.0, ("a", at(60)): 4.0,
        }


def test_replace_scope_removes_rows_and_emptied_dates(spark):
    tables.create_schema(spark, "writers")
    tables.replace_rows(frame(spark, [("a", 0, 1.0), ("a", 30, 2.0), ("a", 60, 3.0)]), "writers.s", BARS)
    scope = spark.createDataFrame([("a", at(20))], "symbol string, start timestamp")
    tables.replace_rows(frame(spark, [("a", 30, 5.0)]), "writers.s", BARS, scope=scope)
    assert closes(spark, "writers.s") == {("a", at(0)): 1.0, ("a", at(30)): 5.0}


def test_only_differing_dates_are_rewritten(spark):
    tables.create_schema(spark, "writers")
    rows = [("a", h, float(h)) for h in range(0, 96, 6)]
    tables.replace_rows(frame(spark, rows), "writers.d", BARS)

    def files():
        return {f.rsplit("/", 2)[-2]: f for f in spark.table("writers.d").inputFiles()}

    before = files()
    scope = spark.createDataFrame([("a", at(0))], "symbol string, start timestamp")
    tables.replace_rows(frame(spark, rows), "writers.d", BARS, scope=scope)
    assert files() == before
    changed = [(s, h, -1.0 if h == 30 else c) for s, h, c in rows]
    tables.replace_rows(frame(spark, changed), "writers.d", BARS, scope=scope)
    after = files()
    assert {d for d in before if before[d] != after[d]} == {"date=2024-01-02"}


def test_older_version_does_not_win(spark):
    tables.create_schema(spark, "writers")
    schema = BRONZE
    rows = [(2, 7.0), (1, 5.0)]
    for seq, close in rows:
        one = frame(spark, [("a", 0, close)]).withColumn("ingest_seq", F.lit(seq).cast("long"))
        tables.replace_rows(one, "writers.v", schema, version="ingest_seq")
    assert closes(spark, "writers.v") == {("a", at(0)): 7.0}


def test_missing_table_is_told_from_failure(spark):
    assert tables.load_or_none(spark, "writers.none") is None
    with pytest.raises(Exception):
        tables.load(spark, "writers.none")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_runs_ends_like_a_recompute(spark, seed):
    """Layers that run ahead of the one before them wait for it; nothing is lost."""
    rng = random.Random(seed)
    layers = Layers(f"orders_{seed}")
    ticks = make_ticks(spark, hours=50, seed=seed).cache()
    steps = [run_silver, run_gold, run_serving]
    for hour in (20.3, 33.1, 50):
        run_bronze(known(ticks, at(hour)), layers, at(hour))
        for step in rng.choices(steps, k=3):
            step(spark, layers)
    for step in steps:
        step(spark, layers)
    check_layers(spark, layers, ticks)


def test_gold_ahead_of_silver_loses_nothing(spark):
    layers = Layers("ahead")
    ticks = make_ticks(spark, hours=45, symbols=("a",)).cache()
    run_bronze(known(ticks, at(30)), layers, at(30))
    run_silver(spark, layers)
    run_gold(spark, layers)
    run_bronze(ticks, layers, at(45))
    run_gold(spark, layers)
    run_serving(spark, layers)
    run_silver(spark, layers)
    run_gold(spark, layers)
    run_serving(spark, layers)
    check_layers(spark, layers, ticks)


def test_new_symbol_with_only_old_ticks(spark):
    layers = Layers("old_ticks")
    old = known(make_ticks(spark, hours=20, symbols=("b",)), at(20))
    new = make_ticks(spark, hours=60, symbols=("a",))
    run_layers(known(new, at(40)), layers, at(40))
    run_layers(new.unionByName(old), layers, at(60), symbols=spark.createDataFrame([("a",)], "symbol string"))
    check_layers(spark, layers, new)
    run_layers(new.unionByName(old), layers, at(60))
    check_layers(spark, layers, new.unionByName(old))


def test_bronze_runs_read_marks_not_bars(spark, monkeypatch):
    """The second load takes its range from the marks and from the last load; bronze is read only to be merged."""
    layers = Layers("marked")
    ticks = make_ticks(spark, hours=60).cache()
    run_bronze(known(ticks, at(40.5)), layers, at(40.5))
    read = []
    load = tables.load_or_none
    monkeypatch.setattr(tables, "load_or_none", lambda s, name: read.append(name) or load(s, name))
    monkeypatch.setattr(tables, "load", lambda s, name: pytest.fail(f"{name} is read whole"))
    late = known(ticks, at(37))  # older than the last load less the overlap: not read again
    run_bronze(ticks.join(late, ["symbol", "tick_id"], "left_anti"), layers, at(60))
    monkeypatch.undo()
    assert "marked.bronze" not in read
    assert same_rows(spark.table("marked.bronze").select(*BARS.fieldNames()), resample(ticks))
    marks = {r["symbol"]: r["max_dt"] for r in spark.table("marked.marks").collect()}
    assert marks == {r["symbol"]: r["datetime"] for r in resample(ticks).groupBy("symbol").agg(F.max("datetime").alias("datetime")).collect()}


def test_repeated_training_replaces_its_rows(spark):
    layers = Layers("again")
    run_layers(make_ticks(spark, hours=90), layers, at(90))
    for run_id in ("r1", "r2", "r1"):
        run_training(spark, layers, run_id)
    runs = spark.table(layers.name("model_runs"))
    assert {r["run_id"]: r["count"] for r in runs.groupBy("run_id").count().collect()} == {"r1": 9, "r2": 9}
    assert spark.table(layers.name("predictions")).count() == 4


def test_new_columns_are_stored(spark):
    tables.create_schema(spark, "writers")
    tables.replace_rows(frame(spark, [("a", 0, 1.0), ("a", 30, 2.0)]), "writers.e", BARS)
    wide = frame(spark, [("a", 30, 5.0), ("a", 60, 6.0)]).withColumn("venue", F.lit("x"))
    tables.replace_rows(wide, "writers.e", BARS)
    tables.replace_rows(frame(spark, [("a", 61, 7.0)]), "writers.e", BARS)
    stored = {(r["datetime"], r["close"], r["venue"]) for r in spark.table("writers.e").collect()}
    assert stored == {(at(0), 1.0, None), (at(30), 5.0, "x"), (at(60), 6.0, "x"), (at(61), 7.0, None)}


def test_columns_widen_and_old_rows_stay_readable(spark, monkeypatch):
    """int -> bigint -> double in stored files; a narrower type that comes later is cast; a text is an error."""
    tables.create_schema(spark, "writers")
    rows = [(0, "int", 1), (30, "bigint", 2**40), (31, "int", 3), (60, "double", 0.5), (61, "bigint", 2**50)]
    for hour, kind, value in rows:
        one = frame(spark, [("a", hour, 1.0)]).withColumn("extra", F.lit(value).cast(kind))
        tables.replace_rows(one, "writers.w", BARS)
    stored = spark.table("writers.w").orderBy("datetime")
    assert stored.schema["extra"].dataType.simpleString() == "double"
    assert [r["extra"] for r in stored.collect()] == [1.0, 2.0**40, 3.0, 0.5, 2.0**50]
    with pytest.raises(ValueError, match="cannot take"):
        tables.replace_rows(frame(spark, [("a", 62, 1.0)]).withColumn("extra", F.lit("x")), "writers.w", BARS)
    assert not spark.catalog.tableExists("writers.w__wide")


def test_a_widening_that_breaks_off_loses_nothing(spark, monkeypatch):
    tables.create_schema(spark, "writers")
    tables.replace_rows(frame(spark, [("a", 0, 1.0)]).withColumn("n", F.lit(1)), "writers.x", BARS)
    wide = frame(spark, [("a", 30, 2.0)]).withColumn("n", F.lit(2**40))
    real = tables._finish_widening
    calls = []

    def broken(spark, table):
        calls.append(table)
        if len(calls) == 2:  # the old table is dropped, the copy not renamed
            raise Broken
        real(spark, table)

    monkeypatch.setattr(tables, "_finish_widening", broken)
    with pytest.raises(Broken):
        tables.replace_rows(wide, "writers.x", BARS)
    monkeypatch.undo()
    tables.replace_rows(wide, "writers.x", BARS)
    assert sorted(r["n"] for r in spark.table("writers.x").collect()) == [1, 2**40]


def test_instants_do_not_pass_through_the_drivers_zone(spark, monkeypatch):
    """In the hour that a zone repeats, a datetime on the driver could mean either of two instants."""
    import time

    from barwright.catalogue import _as_of
    from barwright.operators.marks import from_micros, instant, micros, recent

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        bars = spark.sql(
            "SELECT 'a' AS symbol, timestamp_seconds(1730613600 - 3600 * id) AS datetime, 1.0 AS close FROM range(60)"
        )  # the newest at 2024-11-03 06:00 UTC
        newest = bars.select(F.unix_micros(_as_of(bars))).first()[0]
        assert newest == 1730613600 * 10**6
        assert recent(bars, _as_of(bars)).count() == 49
        when = datetime(2024, 11, 3, 6)
        assert spark.range(1).select(F.unix_micros(instant(when)), F.unix_micros(from_micros(micros(when)))).first()[:] == (newest, newest)
    finally:
        monkeypatch.undo()
        time.tzset()


class Broken(Exception):
    pass


@pytest.mark.parametrize(
    "step, before, breaks",
    [("reserve", False, False), ("replace_rows", True, True), ("replace_rows", False, True), ("snapshot", True, False), ("publish", True, True)],
)
def test_later_layers_may_run_inside_a_load(spark, monkeypatch, step, before, breaks):
    """All layers run before or after a step of a load, which then goes on or breaks off and is repeated."""
    from barwright.plans import layers as plans

    layers = Layers(f"inside_{step}_{before}_{breaks}".lower())
    ticks = make_ticks(spark, hours=12, symbols=("a",)).cache()
    run_layers(known(ticks, at(8.5)), layers, at(8.5))
    owner = tables if hasattr(tables, step) and step in ("replace_rows", "snapshot") else plans
    real = getattr(owner, step)

    def interrupted(*args, **kwargs):
        if not before:
            real(*args, **kwargs)
        monkeypatch.undo()
        for run in (run_silver, run_gold, run_serving):
            run(spark, layers)
        if breaks:
            raise Broken
        return real(*args, **kwargs) if before else plans._records(spark, layers)["reserved"]

    monkeypatch.setattr(owner, step, interrupted)
    if breaks:
        with pytest.raises(Broken):
            run_bronze(ticks, layers, at(12))
        run_silver(spark, layers)
    run_layers(ticks, layers, at(12))
    check_layers(spark, layers, ticks)


def test_a_half_written_load_counts_with_the_next(spark, monkeypatch):
    """Some dates of a load are written, then it breaks off; the next load finds nothing else that is new."""
    layers = Layers("halfway")
    ticks = make_ticks(spark, hours=60, symbols=("a",)).cache()
    run_layers(known(ticks, at(20)), layers, at(20))
    real = tables.replace_rows

    def half(fresh, table, *args, **kwargs):
        real(fresh.filter(F.to_date("datetime") > F.lit("2024-01-01").cast("date")), table, *args, **kwargs)
        raise Broken

    monkeypatch.setattr(tables, "replace_rows", half)
    with pytest.raises(Broken):
        run_bronze(ticks, layers, at(60))
    monkeypatch.undo()
    run_silver(spark, layers)
    run_layers(ticks, layers, at(60))
    check_layers(spark, layers, ticks)


def test_a_load_without_news_writes_nothing(spark):
    layers = Layers("no_news")
    ticks = make_ticks(spark, hours=30).cache()
    run_layers(ticks, layers, at(30))
    names = ("bronze", "silver", "gold", "serving", "marks", "progress")
    before = {n: sorted(spark.table(layers.name(n)).inputFiles()) for n in names}
    run_layers(ticks, layers, at(30))
    run_layers(ticks, layers, at(31), seq=0)
    for n in names:
        spark.catalog.refreshTable(layers.name(n))
        assert sorted(spark.table(layers.name(n)).inputFiles()) == before[n]


def test_equal_bars_keep_their_number(spark, make_bars):
    layers = Layers("numbers")
    tables.create_schema(spark, layers.database)
    rows = series([float(i) for i in range(10)])
    store_bars(make_bars(rows), layers)
    rows[4]["close"] = 99.0
    rows[7]["volume"] = None
    assert store_bars(make_bars([*rows, {"hour": 10, "close": 1.0}]), layers)
    assert not store_bars(make_bars(rows), layers, seq=0)
    rows[2]["close"] = 5.5
    assert store_bars(make_bars(rows), layers, seq=1)  # 1 is published: the next one is taken
    numbers = [r["ingest_seq"] for r in spark.table("numbers.bronze").orderBy("datetime").collect()]
    assert numbers == [0, 0, 2, 0, 1, 0, 0, 1, 0, 0, 1]
