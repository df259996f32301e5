from datetime import datetime, timedelta

from corpusloom.streaming import windows

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def events():
    start = datetime(2026, 1, 1)
    rows = [(i, start + timedelta(minutes=7 * i), i % 3, "view" if i % 2 else "click", float(i)) for i in range(60)]
    return rows + rows[:5] + [(100, start + timedelta(days=2), 1, "view", 1.0)]


def stream(spark, tmp_path, rows, schema=SCHEMA):
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    return spark.readStream.schema(schema).parquet(path)


def run(spark, df, name, mode="append"):
    query = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    query.processAllAvailable()
    query.stop()
    return sorted(map(tuple, spark.table(name).collect()), key=repr)


def test_windows_in_a_stream_equal_the_batch(spark, tmp_path):
    batch = spark.createDataFrame(events(), SCHEMA)
    live = stream(spark, tmp_path, events())
    for name, f in {
        "tumbling": lambda df: windows.windowed_counts(df, "ts", "event_type", "1 hour", value="value"),
        "sliding": lambda df: windows.windowed_counts(df, "ts", "event_type", "2 hours", "1 hour"),
        "sessions": lambda df: windows.sessions(df, "ts", "user_id", "30 minutes"),
    }.items():
        want = sorted((tuple(r) for r in f(batch).collect()), key=repr)
        assert run(spark, f(live), name, "complete" if name != "sessions" else "append") == [w for w in want if name != "sessions" or w[1].day == 1]


def test_repeats_in_a_stream(spark, tmp_path):
    live = stream(spark, tmp_path, events())
    got = run(spark, windows.once(live, "ts", "event_id", late="1 day").select("event_id"), "once")
    assert len(got) == len(set(got)) == 61


def test_accepted_editions(spark, tmp_path):
    rows = [("s", "2026-01"), ("s", "2026-03"), ("s", "2026-02"), ("t", "x")]
    got = run(spark, windows.accepted_editions(stream(spark, tmp_path, rows, "source string, version string"), "source", "version"), "accepted")
    assert got == [("s", "2026-01", True, 1), ("s", "2026-02", True, 2), ("s", "2026-03", True, 3), ("t", "x", True, 1)]
