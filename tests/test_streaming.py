"""Incremental ingest equals the batch rebuild; hourly windowed counts."""

import pytest

from encore.operators import etl
from encore.sources import raw
from encore.streaming import ingest

from test_raw_etl import HEADER, write

COLS = ["user_id", "played_at_utc", "played_at_local", "track_id", "track_name", "artist_id", "artist_name",
        "album_id", "album_name", "duration_ms", "duration_minutes", "popularity", "explicit", "play_hour",
        "play_day_of_week", "play_month", "play_year", "season"]


def snapshot(df):
    return sorted(repr(tuple(r)) for r in df.select(*COLS).collect())


def test_stream_equals_batch(spark, tmp_dir):
    root, table, ckpt = (f"{tmp_dir}/{x}" for x in ("raw", "table", "ckpt"))
    write(f"{root}/u1/recently_played_1.csv", HEADER +
          "2024-01-10T03:46:02.123Z,A,X,Al,t1,a1,al1,1000,50,True\n"
          "2024-01-10T04:46:02.123Z,B,X,Al,t2,a1,al1,1000,50,False\n"
          "bad,C,X,Al,t3,a1,al1,1000,50,False\n")
    ingest.ingest_available(spark, root, table, ckpt)
    assert ingest.read_plays(spark, table).count() == 3
    # second pull overlaps the first (t2 again, with another popularity), brings one new and one very late play
    write(f"{root}/u1/recently_played_2.csv", HEADER +
          "2024-01-10T04:46:02.123Z,B,X,Al,t2,a1,al1,1000,40,False\n"
          "2024-01-12T00:00:00.000Z,D,X,Al,t4,a1,al1,1000,50,False\n"
          "2023-01-01T00:00:00.000Z,E,X,Al,t5,a1,al1,1000,50,False\n"
          "bad,C,X,Al,t3,a1,al1,1000,50,False\n")
    # a new user whose history is older than everything seen
    write(f"{root}/u2/recently_played_1.csv", HEADER + "".join(
        f"2024-01-0{d}T00:10:00.000Z,S,Y,Al,t9,a9,al9,1,5,True\n" for d in range(1, 6)))
    ingest.ingest_available(spark, root, table, ckpt)
    streamed = ingest.read_plays(spark, table)
    batch = etl.clean_plays(raw.read_plays_csv(spark, root), with_time=False)
    assert snapshot(streamed) == snapshot(batch)                      # Z02
    assert streamed.count() == 10                                     # t1 t2 t3 t4 t5 + five old plays of u2
    assert streamed.filter("track_id = 't2'").collect()[0].popularity == 40
    counts = ingest.read_hourly(spark, table)                        # Z03: late hours too, nothing missing
    want = ingest.hourly_counts(batch)
    assert sorted(map(repr, counts.collect())) == sorted(map(repr, want.collect())) and counts.count() == 9


def _rows(spark, *plays):
    r = spark.createDataFrame([(*p, None, "Ar", "Al", "a1", "al1", 1000, 50, True) for p in plays],
                              "user_id string, played_at string, track_id string, track_name string, artist_name string, album_name string, "
                              "artist_id string, album_id string, duration_ms int, popularity int, explicit boolean")
    return etl.clean_plays_rows(r)


def test_crashes_and_retries_lose_nothing(spark, tmp_dir, monkeypatch):
    table = f"{tmp_dir}/t"
    first, second = _rows(spark, ("u", "2024-01-10T00:00:00Z", "t1")), _rows(spark, ("u", "2024-01-11T00:00:00Z", "t2"), ("u", "2024-01-11T00:00:00Z", "t2"))
    ingest.write_batch(first, table, 0)
    with monkeypatch.context() as m:      # the job dies before batch 1 is written
        m.setattr(ingest, "keep_one", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            ingest.write_batch(second, table, 1)
    assert [r.track_id for r in ingest.read_plays(spark, table).collect()] == ["t1"]
    for _ in range(2):                    # the retry, and a second one
        ingest.write_batch(second, table, 1)
        assert sorted(r.track_id for r in ingest.read_plays(spark, table).collect()) == ["t1", "t2"]
    ingest.write_batch(second.limit(0), table, 2)
    ingest.write_batch(first, table, 3)   # an overlapping pull
    assert ingest.read_plays(spark, table).count() == 2 and ingest.read_rows(spark, table).count() == 3


def test_compaction_and_batches_after_it(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    for n in range(3):
        ingest.write_batch(_rows(spark, ("u", f"2024-01-1{n}T00:00:00Z", "t"), ("u", "2024-01-10T00:00:00Z", "t")), table, n)
    whole = snapshot(ingest.read_plays(spark, table))
    last = ingest.compact(spark, table, f"{tmp_dir}/c1")
    assert last == 2 and spark.read.parquet(f"{tmp_dir}/c1").count() == 3
    assert snapshot(ingest.read_plays(spark, table, f"{tmp_dir}/c1", last)) == whole
    ingest.write_batch(_rows(spark, ("u", "2024-01-05T00:00:00Z", "late"), ("u", "2024-01-11T00:00:00Z", "t")), table, 3)
    both = ingest.read_plays(spark, table, f"{tmp_dir}/c1", last)
    assert snapshot(both) == snapshot(ingest.read_plays(spark, table)) and both.count() == 4
    files = [f for f in both.inputFiles() if "/t/" in f]
    assert ingest.read_rows(spark, table, last).count() == 2 and files
    assert ingest.compact(spark, table, f"{tmp_dir}/c2", f"{tmp_dir}/c1", last) == 3
    assert snapshot(ingest.read_plays(spark, table, f"{tmp_dir}/c2", 3)) == snapshot(both)
    hours = ingest.read_hourly(spark, table, f"{tmp_dir}/c2", 3)
    assert sorted(map(repr, hours.collect())) == sorted(map(repr, ingest.read_hourly(spark, table).collect()))


def test_empty_table(spark, tmp_dir):
    assert ingest.read_plays(spark, f"{tmp_dir}/none").count() == 0 and ingest.compact(spark, f"{tmp_dir}/none", f"{tmp_dir}/c") is None
