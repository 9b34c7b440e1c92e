"""Raw files -> cleaned tables (S01-S10, S16, S17, S19-S23, C01-C04, A17) and traps T1-T4, T9, T19, T27."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from encore.operators import etl
from encore.plans import jobs
from encore.sources import raw, sinks

HEADER = "played_at,track_name,artist_name,album_name,track_id,artist_id,album_id,duration_ms,popularity,explicit\n"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def make_plays(root):
    write(f"{root}/u1/recently_played_20240101_000000.csv", HEADER +
          "2024-01-10T03:46:02.123Z,  Song A ,Artist X,Album,t1,a1,al1,180000,55,True\n"
          "2024-01-10T04:00:00Z,Song B,,\"Album, with comma\",t2,a2,al2,,,False\n"     # no millis, NULL artist name
          "bad,Song C,   ,Álbum,t3,a3,al3,1000,101,False\n"                           # garbage time, blank name
          ",Song D,Artist Y,Album,t4,a4,al4,1000,5,False\n"                             # missing time -> dropped
          "2024-01-10T05:00:00.000Z,Song E,Artist Z,Album,,a5,al5,1000,5,False\n")      # missing track -> dropped
    # overlapping second pull: one duplicate (different popularity) and one new row
    write(f"{root}/u1/recently_played_20240101_040000.csv", HEADER +
          "2024-01-10T03:46:02.123Z,Song A,Artist X,Album,t1,a1,al1,180000,60,True\n"
          "2024-06-10T12:00:00.000Z,Song F,Artist X,Album,t6,a1,al1,90000,70,False\n")
    write(f"{root}/u2/export.csv", HEADER + "2024-01-11T00:00:00.000Z,S,Ar,Al,t9,a9,al9,60000,50,True\n")
    os.makedirs(f"{root}/u3", exist_ok=True)   # user without files


def test_plays_csv_etl(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    make_plays(root)
    r = raw.read_plays_csv(spark, root)
    assert r.select("user_id").distinct().count() == 2                      # S06, S08
    counts = {(x.user_id, x.source_file): x.records for x in raw.per_file_counts(r).collect()}   # S09
    assert counts[("u1", "recently_played_20240101_000000.csv")] == 5
    clean = etl.clean_plays(r).cache()
    rows = {(x.user_id, x.track_id): x for x in clean.collect()}
    assert set(rows) == {("u1", "t1"), ("u1", "t2"), ("u1", "t3"), ("u1", "t6"), ("u2", "t9")}
    a = rows[("u1", "t1")]
    assert a.track_name == "Song A"                                         # P04 trim
    assert a.popularity == 55                                                # T19 deterministic survivor (min)
    assert a.played_at_local == dt.datetime(2024, 1, 9, 21, 46, 2, 123000)   # T1: UTC-6 wall clock
    assert a.play_hour == 21 and a.play_day_of_week == 3 and a.season == "Winter"
    assert a.duration_minutes == 3.0
    b = rows[("u1", "t2")]
    assert b.played_at_local == dt.datetime(2024, 1, 9, 22, 0)              # T2: no millis still parses
    assert b.artist_name == "Unknown Artist" and b.duration_ms == 0 and b.popularity == 0   # P05
    c = rows[("u1", "t3")]
    assert c.played_at_utc is None and c.season == "Winter"                  # T2 garbage -> NULL, T3
    assert c.artist_name == ""                                               # T4 blank stays ''
    assert rows[("u1", "t6")].season == "Summer"
    q = {x.user_id: x for x in etl.plays_quality_one_pass(r).collect()}     # A17 without the clean table
    assert q["u1"].raw_records == 7 and q["u1"].valid_records == 5 and q["u1"].clean_records == 4
    assert q["u1"].duplicates_removed == 1 and q["u1"].null_track_ids == 1 and q["u1"].unparsed_times == 1
    same = {x.user_id: x for x in jobs.table_quality("user_tracks", r, clean).collect()}   # A17 beside the clean table
    for k, v in same.items():
        assert all(v[c] == q[k][c] for c in ("raw_records", "null_track_ids", "valid_records", "clean_records", "duplicates_removed", "min_utc", "max_utc"))
    write(f"{root}/u4/empty.csv", HEADER)                                   # S08: a file without rows is input
    listed = raw.list_files(spark, root, "*.csv")
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[-1]
    assert listed.filter("user_id = 'u1'").count() == 2
    pres = {x.user_id: x.has_input for x in raw.user_presence(
        listed, spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u4",)], "user_id string")).collect()}
    assert pres == {"u1": True, "u2": True, "u3": False, "u4": True}
    one = raw.read_plays_csv(spark, root, user_id="u2")
    assert [x.user_id for x in one.select("user_id").distinct().collect()] == ["u2"]


def test_all_users_equals_union_of_single_users(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    make_plays(root)
    all_users = etl.clean_plays(raw.read_plays_csv(spark, root), with_time=False)
    single = etl.clean_plays(raw.read_plays_csv(spark, root, "u1"), with_time=False).unionByName(
        etl.clean_plays(raw.read_plays_csv(spark, root, "u2"), with_time=False))
    assert sorted(map(repr, all_users.collect())) == sorted(map(repr, single.collect()))


def test_job_from_files_to_table_with_reports(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    make_plays(root)
    write(f"{root}/u5/recently_played_1.csv", HEADER + ",No time,A,B,t,a,al,1,1,True\n")
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",), ("u5",)], "user_id string")
    res = jobs.run_job(spark, "user_tracks", root, f"{tmp_dir}/out", users)
    assert res.table.count() == 5 and os.path.isdir(f"{res.path}/user_id=u1")                    # C01, S10
    got = {r.user_id: (r.status, r.clean_records, r.files, r.file_records) for r in res.outcome.collect()}   # A26
    assert got == {"u1": ("processed", 4, 2, 7), "u2": ("processed", 1, 1, 1), "u3": ("skipped", 0, 0, 0), "u5": ("failed", 0, 1, 1)}
    total = jobs.outcome_summary(res.outcome).first()
    assert (total.users, total.processed, total.failed, total.skipped, total.files, total.file_records) == (4, 2, 1, 1, 4, 9)


def test_per_user_sink_and_idempotent_dedup(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    make_plays(root)
    clean = etl.clean_plays(raw.read_plays_csv(spark, root), with_time=False)
    out = sinks.write_per_user(clean, f"{tmp_dir}/user_tracks", ["played_at_utc"])   # S10 + K03
    back = spark.read.parquet(out)
    assert {"user_id=u1", "user_id=u2"} <= set(os.listdir(out))
    assert back.count() == clean.count()
    again = etl.finish_plays(back.select(*[c for c in back.columns if c not in (
        "play_hour", "play_day_of_week", "play_month", "play_year", "duration_minutes", "season", "processed_at")]),
        with_time=False)
    assert again.count() == back.count()                                    # dedup is idempotent


def test_json_documents(spark, tmp_dir):
    root = f"{tmp_dir}/raw"
    likes = [
        {"track_id": "t1", "album_id": "al", "artists_id": ["a1", "a2"], "explicit": True, "duration_ms": 1000,
         "track_name": " L1 ", "track_popularity": 40, "added_at": "2024-01-10T10:00:00Z"},
        {"track_id": "t2", "album_id": None, "artists_id": [], "explicit": None, "duration_ms": None,
         "track_name": None, "track_popularity": None, "added_at": "2024-01-11T10:00:00Z"},
        {"track_id": "t3", "album_id": "al", "artists_id": None, "explicit": False, "duration_ms": 5,
         "track_name": "L3", "track_popularity": 1, "added_at": "2024-01-12T10:00:00Z"},
    ]
    write(f"{root}/u1/likes_list.json", json.dumps(likes, indent=4))
    write(f"{root}/u1/likes_list_old.json", json.dumps(likes[:1], indent=4))     # same like in two files
    write(f"{root}/u1/followed_artists.json", json.dumps({"artists_ids": ["a1", "a2", "a1"]}))
    write(f"{root}/u2/followed_artists.json", json.dumps({"artists_ids": []}))
    tops = [{"ith_preference": 1, "track_id": "t1", "album_id": "al", "artists_id": ["a1"], "explicit": True,
             "duration": 2000, "track_name": " T1", "track_popularity": 90},
            {"ith_preference": 2, "track_id": "t2", "album_id": "al", "artists_id": [], "explicit": False,
             "duration_ms": 3000, "track_name": "T2", "track_popularity": 80}]
    write(f"{root}/u1/top_tracks.json", json.dumps(tops, indent=4))
    write(f"{root}/u1/notes.txt", "ignored")

    lk = etl.clean_likes(raw.read_likes_json(spark, root), with_time=False)      # C02
    rows = {x.track_id: x for x in lk.collect()}
    assert len(rows) == 3                                                    # U04 dedup across files
    assert rows["t1"].artists_id == "a1" and rows["t1"].track_name == "L1"   # P15, P04
    assert rows["t2"].artists_id == "-1" and rows["t3"].artists_id == "-1"   # T27 empty / null arrays
    assert rows["t2"].track_name == "Unknown Track" and rows["t2"].album_id == "-1"
    assert rows["t1"].added_at_local == dt.datetime(2024, 1, 10, 4, 0)

    fo = etl.clean_follows(raw.read_followed_json(spark, root), with_time=False)  # C03, S03
    assert sorted((x.user_id, x.artist_id) for x in fo.collect()) == [("u1", "a1"), ("u1", "a2")]

    tt = etl.clean_top_tracks(raw.read_top_tracks_json(spark, root), with_time=False)   # C04, T9
    t = {x.ith_preference: x for x in tt.collect()}
    assert t[1].duration_ms == 2000 and t[2].duration_ms == 3000
    assert t[1].track_name == "T1" and t[2].artists_id == "-1"


def test_api_pages_flatten(spark, tmp_dir):
    root = f"{tmp_dir}/pages"
    track = {"id": "t1", "name": "N", "duration_ms": 1, "popularity": 2, "explicit": True,
             "artists": [{"id": "a1", "name": "A1"}, {"id": "a2", "name": "A2"}], "album": {"id": "al", "name": "AL"}}
    write(f"{root}/u1/recent_page.json", json.dumps({"items": [{"played_at": "2024-01-01T00:00:00.000Z",
                                                              "track": track}]}))
    p = raw.flatten_play_items(raw.read_pages(spark, root, raw.PLAYS_PAGE_DDL, "recent_*.json")).collect()[0]  # S19
    assert (p.artist_name, p.artist_id, p.album_name, p.track_id) == ("A1", "a1", "AL", "t1")
    write(f"{root}/u1/saved_page.json", json.dumps({"items": [{"added_at": "2024-01-01T00:00:00Z", "track": track}]}))
    lk = raw.flatten_like_items(raw.read_pages(spark, root, raw.LIKES_PAGE_DDL, "saved_*.json")).collect()[0]  # S20
    assert lk.artists_id == ["a1", "a2"]
    t2 = dict(track, id="t2")
    t3 = dict(track, id="t3")
    write(f"{root}/u1/top_0.json", json.dumps({"items": [track, t2]}))
    write(f"{root}/u1/top_1.json", json.dumps({"items": [t3]}))
    tops = raw.flatten_top_items(raw.read_pages(spark, root, raw.TOP_PAGE_DDL, "top_*.json"))   # S21 + S23
    assert [(x.ith_preference, x.track_id) for x in tops.orderBy("ith_preference").collect()] == \
        [(1, "t1"), (2, "t2"), (3, "t3")]


def test_csv_sink_and_profile_fallback(spark, tmp_dir):
    df = spark.createDataFrame([("u1", 1, "Casual Listener")], "user_id string, cluster int, profile_name string")
    path = sinks.write_csv(df, f"{tmp_dir}/profiles_csv")                    # S16
    assert spark.read.option("header", True).csv(path).count() == 1
    missing = raw.read_profiles(spark, f"{tmp_dir}/does_not_exist")          # S17
    assert missing.count() == 0 and "profile_name" in missing.columns


def test_followed_document_json(spark):
    from encore.operators.explore import followed_document
    d = followed_document(spark.createDataFrame([("u", "b"), ("u", "a")], "user_id string, artist_id string"))
    assert json.loads(d.collect()[0].document) == {"artists_ids": ["a", "b"]}


def test_parse_is_session_zone_independent(spark):
    from encore.functions.time import parse_utc
    df = spark.createDataFrame([("2024-01-10T03:46:02.123Z",)], "s string")
    spark.conf.set("spark.sql.session.timeZone", "America/Mexico_City")
    try:
        epoch = df.select(F.unix_micros(parse_utc("s")).alias("e")).collect()[0].e
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert epoch == int(dt.datetime(2024, 1, 10, 3, 46, 2, 123000, tzinfo=dt.timezone.utc).timestamp() * 1e6)


def test_followed_document_splits_large_users(spark):
    from encore.operators.explore import followed_document
    rows = [("big", f"a{i:03d}") for i in range(50)] + [("small", "x")]
    docs = followed_document(spark.createDataFrame(rows, "user_id string, artist_id string"), max_ids=10).collect()
    big = [json.loads(d.document)["artists_ids"] for d in docs if d.user_id == "big"]
    assert 2 <= len(big) <= 5 and sorted(x for d in big for x in d) == [f"a{i:03d}" for i in range(50)]
    assert [(d.document_no, json.loads(d.document)) for d in docs if d.user_id == "small"] == [(0, {"artists_ids": ["x"]})]
    assert len({d.document_no for d in docs if d.user_id == "big"}) == len(big)


def test_text_that_is_no_time_gives_null(spark):
    from encore.functions.time import parse_utc
    texts = ["12:30", "T01:00", "2024", "2024-01-10", "2024-01-10T03:46:02Z", "2024-01-10T03:46:02.123Z", "2024-01-10 03:46:02", "bad", "", None]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "s string").select(parse_utc("s").alias("t")).collect()]
    assert [t is not None for t in got] == [False, False, False, False, True, True, False, False, False, False]
    raw = spark.createDataFrame([("u", "12:30", None, None, None, "t", "a", None, 1, 1, True)],
                                "user_id string, played_at string, track_name string, artist_name string, album_name string, "
                                "track_id string, artist_id string, album_id string, duration_ms int, popularity int, explicit boolean")
    assert etl.clean_plays(raw).first().played_at_utc is None


def test_pages_never_pass_their_size(spark):
    """One key in nearly all rows of a user still fills pages one after another."""
    from encore.plans.queries_ingest import _pages
    rows = [("u", "hot")] * 5000 + [("u", f"a{i}") for i in range(100)] + [("v", "x")]
    paged = _pages(spark.createDataFrame(rows, "user_id string, artist_id string"), ["artist_id"], 30)
    sizes = [r["count"] for r in paged.groupBy("user_id", "_chunk", "_page").count().collect()]
    assert max(sizes) <= 30 and sum(sizes) == 5101 and len(sizes) <= 5101 / 30 + 6
