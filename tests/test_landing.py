"""Landing and listing for many users: the number of tasks and folders follows the bytes or the cores, not the users."""

import os

import pytest
from pyspark.sql import functions as F

from encore.plans import jobs
from encore.plans import queries_ingest as QI
from encore.session import LISTING, ensure_session
from encore.sources import quarantine as Q
from encore.sources import raw, sinks

USERS = 60


def play_rows(spark):
    """Three plays a user; one without user, one with an empty name, one with padded text."""
    rows = [(str(u), f"2024-01-0{d}T10:00:00.000Z", None, ["  A ", "", "B, \"C\""][d - 1], None, f"T{d}", f"A{u % 3}", None, 1000, 5, True)
            for u in range(USERS) for d in (1, 2, 3)] + [(None, "bad", None, None, None, "T9", "A9", None, None, None, None)]
    return spark.createDataFrame(rows, "user_id string, played_at string, track_name string, artist_name string, album_name string, "
                                       "track_id string, artist_id string, album_id string, duration_ms int, popularity int, explicit boolean")


def folders(path):
    return [d for d in os.listdir(path) if os.path.isdir(f"{path}/{d}")]


def same(a, b):
    cols = sorted(a.columns)
    return sorted(map(repr, a.select(cols).collect())) == sorted(map(repr, b.select(cols).collect()))


def test_a_listing_has_a_few_tasks_a_core(spark):
    spark.conf.unset(LISTING)
    assert int(ensure_session(spark).conf.get(LISTING)) == max(32, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set(LISTING, "7")   # a session's own choice stays
    try:
        assert ensure_session(spark).conf.get(LISTING) == "7"
    finally:
        spark.conf.unset(LISTING)
        ensure_session(spark)


def test_grouped_plays_read_like_a_folder_per_user(spark, tmp_dir):
    rows = play_rows(spark)
    each, all_in_one = (raw.stage_plays_csv(rows, f"{tmp_dir}/{k}", grouped=bool(k)) for k in (0, 1))
    assert len(folders(each)) == USERS + 1 and folders(all_in_one) == [raw.GROUPED]
    a, b = raw.read_plays_csv(spark, each), raw.read_plays_csv(spark, all_in_one, grouped=True)
    assert a.columns == b.columns and same(a.drop("source_file"), b.drop("source_file"))
    assert raw.read_plays_csv(spark, all_in_one, user_id="7", grouped=True).count() == 3


def test_grouped_documents_read_like_a_folder_per_user(spark, tmp_dir):
    docs = spark.createDataFrame([(str(u), ["A1", "A2"][:u % 3]) for u in range(USERS)], "user_id string, artists_ids array<string>")
    each, all_in_one = raw.land_per_user(docs, f"{tmp_dir}/a", "json"), raw.land_grouped(docs, f"{tmp_dir}/b", "json")
    a = raw.read_followed_json(spark, each, multi_line=False, routed=False)
    b = raw.read_followed_json(spark, all_in_one, multi_line=False, routed=False, grouped=True)
    assert a.count() == USERS and same(a.drop("source_file"), b.drop("source_file"))


def test_rejected_records_of_grouped_files_keep_their_user(spark, tmp_dir):
    good = play_rows(spark).where("user_id is not null")
    root = raw.stage_plays_csv(good, f"{tmp_dir}/raw", grouped=True)
    raw.stage_plays_csv(good.where("track_id = 'T1'").withColumn("duration_ms", F.lit("n/a")), root, mode="append", grouped=True)
    rows, rejected = Q.split_records(raw.read_plays_csv(spark, root, corrupt=Q.RECORD, grouped=True), f"{tmp_dir}/quarantine")
    assert rows.count() == 3 * USERS
    assert sorted(r.user_id for r in rejected.collect()) == sorted(map(str, range(USERS)))


@pytest.mark.parametrize("new", [False, True])
def test_users_folders_are_shared_by_all_tasks(spark, tmp_dir, new):
    path = sinks.write_per_user(play_rows(spark), f"{tmp_dir}/t", ["played_at"], new=new)
    assert len(folders(path)) == USERS + 1
    writers = {f.split("-")[1] for d in folders(path) for f in os.listdir(f"{path}/{d}") if f.startswith("part-")}
    assert len(writers) > 4   # one task wrote all when partitions were merged by bytes
    assert spark.conf.get(sinks.COALESCE) == "true"


def test_a_rerun_replaces_the_users_it_has(spark, tmp_dir):
    rows = play_rows(spark).where("user_id is not null")
    path = sinks.write_per_user(rows, f"{tmp_dir}/t", ["played_at"], new=True)
    sinks.write_per_user(rows.where("user_id = '3' and track_id = 'T1'"), path, ["played_at"])
    read = spark.read.schema("user_id string, track_id string").parquet(path)
    assert read.count() == 3 * USERS - 2 and read.where("user_id = '3'").count() == 1


@pytest.mark.parametrize("name", list(jobs.JOBS))
def test_job_input_does_not_grow_folders_with_users(spark, name):
    root, options = QI._job_input(spark, "/root/testdata/sf0.001", name)
    assert folders(root) == [raw.GROUPED] and options["grouped"]


def test_folders_per_user_hold_no_checksum_files(spark, tmp_dir):
    """Each such file costs a local file system several forks."""
    rows = play_rows(spark).where("user_id is not null")
    root = raw.stage_plays_csv(rows, f"{tmp_dir}/in")
    table = sinks.write_per_user(rows, f"{tmp_dir}/table", ["played_at"], new=True)
    again = sinks.write_per_user(rows, sinks.write_per_user(rows, f"{tmp_dir}/again", ["played_at"]), ["played_at"])
    for path in (root, table, again):
        names = [f for d in folders(path) for f in os.listdir(f"{path}/{d}")]
        assert len(folders(path)) == USERS and len(names) == USERS and not [f for f in names if f.endswith(".crc")]
    for path in (table, again):
        assert same(spark.read.schema(rows.schema).parquet(path), rows)
    assert same(raw.read_plays_csv(spark, root).select("user_id", "played_at", "track_id"), rows.select("user_id", "played_at", "track_id"))
