"""Streams fed in several files must give what one batch gives."""

import datetime as dt


from tidemark.operators import forecast as FC
from tidemark.streaming import flows as S
from tidemark.streaming import timers as TM


def write_parts(df, path, conditions):
    for i, c in enumerate(conditions):
        df.filter(c).coalesce(1).write.parquet(f"{path}/part={i}")


def test_ema_state_survives_batches(spark, tmp_path):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [(e, day(i), float((i * 7 + e * 3) % 11)) for e in (1, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "entity long, date date, close double")
    write_parts(df, f"{tmp_path}/in", ["day(date) <= 10", "day(date) between 11 and 20", "day(date) > 20"])
    s = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    S.run_to_end(S.ema_crosses(s), f"{tmp_path}/cp", f"{tmp_path}/out")
    got = {(r.entity, r.date): (r.ema, r.is_cross) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert len(got) == 60
    for e in (1, 2):
        ema, above, fired = None, False, -10**6
        for n, (_, d, c) in enumerate(r for r in rows if r[0] == e):
            ema = c if ema is None else c / 3 + ema * 2 / 3
            cross = n > 0 and c > ema and not above and n - fired >= 3
            fired = n if cross else fired
            above = c > ema
            assert abs(got[(e, d)][0] - ema) < 1e-9 and got[(e, d)][1] == cross


def test_late_ticks_beyond_the_watermark_are_dropped_and_bars_are_final(spark, tmp_path):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    first = spark.createDataFrame([(1, t(1), 5.0), (1, t(5), 9.0), (1, t(60), 1.0)], "entity long, ts timestamp, value double")
    late = spark.createDataFrame([(1, t(2), 99.0), (1, t(90), 1.0)], first.schema)
    first.coalesce(1).write.parquet(f"{tmp_path}/in/part=0")
    s = lambda: spark.readStream.schema(first.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    S.run_to_end(S.tick_bars(s()), f"{tmp_path}/cp", f"{tmp_path}/out")
    late.coalesce(1).write.parquet(f"{tmp_path}/in/part=1")
    S.run_to_end(S.tick_bars(s()), f"{tmp_path}/cp", f"{tmp_path}/out")  # resumes from the checkpoint
    got = {r.date: (r.open, r.high, r.close, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got[dt.date(2024, 1, 1)] == (5.0, 9.0, 9.0, 2)


def test_restatement_recomputes_touched_entities_only(spark, tmp_path):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    bars = spark.createDataFrame([(e, day(i), 10.0, 10.0, 10.0, 10.0, 100) for e in (1, 2) for i in range(5)], "entity long, date date, open double, high double, low double, close double, volume long")
    cols = "entity long, date date, event_type string, before_price double, reference_price double, cash_dividend double, stock_dividend double, subscription_price double, subscription_rate double, volume_factor double"
    ev = lambda e, i: spark.createDataFrame([(e, day(i), "split", 10.0, 5.0, None, None, None, None, None)], cols)
    sink = S.restate(bars, f"{tmp_path}/log", f"{tmp_path}/out")
    sink(ev(1, 2), 0)
    sink(ev(2, 1), 1)
    sink(ev(1, 4), 2)
    sink(ev(1, 4), 2)  # a replayed batch changes nothing
    got = {(r.entity, r.date): r.adj_close for r in S.versioned(spark, f"{tmp_path}/out").collect()}
    assert got[(1, day(0))] == 40.0 and got[(1, day(3))] == 20.0 and got[(1, day(4))] == 10.0 and got[(2, day(0))] == 20.0 and len(got) == 10
    assert spark.read.parquet(f"{tmp_path}/out/batch=2").select("entity").distinct().count() == 1


def test_forecasts_are_settled_by_timers_across_restarts(spark, tmp_path):
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    bars = spark.createDataFrame([(1, day(0), 10.0), (1, day(3), 11.0), (2, day(0), 5.0), (2, day(9), 6.0), (2, day(40), 7.0), (2, day(41), 8.0)], "entity long, date date, close double")
    asks = [(1, day(0), 2, 9.0, 10.5), (1, day(3), 5, 0.0, 10.0), (1, day(3), 30, 0.0, 20.0), (1, day(3), 90, 0.0, 20.0), (1, day(3), 6, None, 20.0), (2, day(9), 31, 6.5, 9.0), (2, day(9), 32, 8.5, 9.0)]
    f = spark.createDataFrame([(e, d, "s", h, 0.8, lo, hi) for e, d, h, lo, hi in asks], "entity long, forecast_date date, source string, horizon int, confidence double, lower double, upper double")
    rows = TM.feed(f, bars)
    epoch = (day(0) - dt.date(1970, 1, 1)).days
    seen = []
    for i, part in enumerate((f"day <= {epoch + 3}", f"day between {epoch + 4} and {epoch + 20}", f"day > {epoch + 20}")):
        rows.filter(part).coalesce(1).write.parquet(f"{tmp_path}/in/part={i}")
        s = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        S.run_to_end(TM.settle_at_timers(s), f"{tmp_path}/cp", f"{tmp_path}/out")  # each run resumes from the state before
        seen.append(spark.read.parquet(f"{tmp_path}/out").count())
    got = {(r.entity, r.horizon): (r.realized, r.hit, r.resolved_date) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    # (1, 30) has no bar within 21 days, (1, 90) is not due, (1, 6) has no bounds; entity 1 has no bar after its timers were set
    assert got == {(1, 2): (10.0, True, day(2)), (1, 5): (11.0, False, day(8)), (2, 31): (7.0, True, day(40)), (2, 32): (8.0, False, day(41))}
    assert seen == [1, 2, 4]


def test_forecasts_of_a_day_travel_in_one_row(spark):
    day = dt.date(2024, 1, 1)
    bars = spark.createDataFrame([(1, day, 10.0)], "entity long, date date, close double")
    f = spark.createDataFrame([(1, day, "s", h, c, 9.0, 11.0) for h in (1, 2, 3) for c in (0.5, 0.8)], "entity long, forecast_date date, source string, horizon int, confidence double, lower double, upper double")
    assert TM.feed(f, bars).count() == 2
    assert TM.feed(f, bars).filter("grid is not null").first().lower == [9.0] * 6


def test_forecasts_settled_on_arrival_stay_in_the_rows_of_their_bars(spark, tmp_path, monkeypatch):
    """As one batch settles them, each once; of a batch only its bars are shuffled, and only the columns asked for are written."""
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [(e, day(i), None if (e, i) == (2, 50) else 50.0 + (i * 7 + e * 3) % 11) for e in (1, 2) for i in range(100) if (e, i % 9) != (2, 4)]
    bars = spark.createDataFrame([*rows, (1, None, 44.0)], "entity long, date date, close double")
    plans, settle = [], FC.settle_realized
    monkeypatch.setattr(FC, "settle_realized", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), settle(df))[1])
    issue = lambda b: FC.baseline_rows(FC.baseline_inputs(FC.unadjusted(b), in_order=True), realized=True)
    cols = ["entity", "forecast_date", "horizon", "confidence", "realized", "hit"]
    sink = S.settle_on_arrival(issue, f"{tmp_path}/log", f"{tmp_path}/out", cols)
    parts = [bars.filter("date is null or date < '2024-02-20'"), bars.filter("date >= '2024-02-20'")]
    for i in (0, 1, 1):  # a replayed batch changes nothing
        sink(parts[i], i)
    got = spark.read.option("basePath", f"{tmp_path}/out").parquet(f"{tmp_path}/out/batch=*").drop("batch")
    want = FC.settle(FC.baseline(FC.every_bar(FC.unadjusted(bars))), bars, str(day(99)))
    read = lambda df: sorted(tuple(r[c] for c in cols) for r in df.collect())
    assert got.columns == cols and read(got) == read(want) != []
    assert plans and all(sum("Exchange" in line for line in p.splitlines()) == 1 for p in plans), plans


def test_timers_issue_from_the_closes_in_their_state(spark, tmp_path):
    """Forecasts issued inside the state are those of one batch, also across restarts; the feed holds bars only."""
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    rows = [(e, day(i), None if (e, i) == (2, 50) else 50.0 + (i * 7 + e * 3) % 11) for e in (1, 2) for i in range(100) if (e, i % 9) != (2, 4)]
    bars = spark.createDataFrame([*rows, (1, None, 44.0)], "entity long, date date, close double")
    feed = TM.bar_feed(bars)
    assert feed.columns == ["entity", "day", "close"]
    epoch = (day(0) - dt.date(1970, 1, 1)).days
    for i, part in enumerate((f"day is null or day < {epoch + 30}", f"day between {epoch + 30} and {epoch + 59}", f"day >= {epoch + 60}")):
        feed.filter(part).write.parquet(f"{tmp_path}/in/part={i}")
        s = spark.readStream.schema(feed.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        # a short look-back, so that the state forgets
        S.run_to_end(TM.settle_at_timers(s, issue=FC.baseline_issuer((3, 5), (0.5, 0.8), 4, 10)), f"{tmp_path}/cp", f"{tmp_path}/out")
    want = FC.settle(FC.baseline(FC.every_bar(FC.unadjusted(bars)), (3, 5), (0.5, 0.8), 4, 10), bars.filter("close is not null"), str(day(99)))
    cols = ["entity", "forecast_date", "source", "horizon", "confidence", "lower", "upper", "resolved_date", "realized", "hit", "pinball"]
    read = lambda df: {tuple(r[c] for c in cols) for r in df.collect()}
    got, want = read(spark.read.parquet(f"{tmp_path}/out")), read(want)
    assert got == want and len(got) > 600
