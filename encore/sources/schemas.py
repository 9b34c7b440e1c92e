"""Schema registry: one entry per table (raw inputs and cleaned outputs).

Drives the declared reads (no inference), the final column order (P14), the
dedup keys (U03-U06), the storage sort (K03) and the catalog DDL (S13/S14).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

# Raw inputs -----------------------------------------------------------------

RAW_PLAYS_DDL = ("played_at string, track_name string, artist_name string, album_name string, "
                 "track_id string, artist_id string, album_id string, duration_ms int, popularity int, "
                 "explicit boolean")
RAW_LIKES_DDL = ("track_id string, album_id string, artists_id array<string>, explicit boolean, "
                 "duration_ms int, track_name string, track_popularity int, added_at string")
RAW_FOLLOWED_DDL = "artists_ids array<string>"
RAW_TOP_TRACKS_DDL = ("ith_preference int, track_id string, album_id string, artists_id array<string>, "
                      "explicit boolean, duration_ms int, duration int, track_name string, track_popularity int")
RAW_ARTISTS_DDL = "id string, name string, popularity int, followers bigint, genres array<string>"


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    key: tuple[str, ...]
    sort: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    description: str = ""
    properties: dict = field(default_factory=dict)

    @property
    def table_properties(self) -> dict[str, str]:
        """What the catalog records beside the schema: format, key and storage order, and the table's own entries."""
        base = {"classification": "parquet", "encore.key": ",".join(self.key), "encore.sort": ",".join(self.sort)}
        return {k: v for k, v in (base | self.properties).items() if v}

    @property
    def columns(self) -> list[str]:
        return [f.name for f in StructType.fromDDL(self.ddl).fields]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


TABLES: dict[str, TableSpec] = {t.name: t for t in [
    TableSpec(
        "user_tracks",
        "user_id string, played_at_utc timestamp, played_at_local timestamp_ntz, track_id string, "
        "track_name string, artist_id string, artist_name string, album_id string, album_name string, "
        "duration_ms bigint, duration_minutes double, popularity int, explicit boolean, play_hour int, "
        "play_day_of_week int, play_month int, play_year int, season string, processed_at timestamp",
        key=("user_id", "track_id", "played_at_utc"), sort=("played_at_utc",), partition_by=("user_id",),
        description="Cleaned, deduplicated play history"),
    TableSpec(
        "play_history",
        "user_id string, played_at_utc timestamp, played_at_local timestamp_ntz, track_id string, artist_id string, artist_name string, "
        "duration_ms bigint, duration_minutes double, popularity int, explicit boolean, play_hour int, play_day_of_week int, play_month int, "
        "play_year int, season string, play_month_key string, user_bucket int",
        key=("user_id", "track_id", "played_at_utc"), sort=("user_id", "played_at_utc"), partition_by=("play_month_key", "user_bucket"),
        description="Play history by local month and user bucket, for trailing windows"),
    TableSpec(
        "likes",
        "user_id string, added_at_utc timestamp, added_at_local timestamp_ntz, track_id string, "
        "track_name string, artists_id string, album_id string, track_popularity int, explicit boolean, "
        "duration_ms bigint, processed_at timestamp",
        key=("user_id", "track_id", "added_at_utc"), sort=("added_at_utc",), partition_by=("user_id",),
        description="Liked tracks"),
    TableSpec(
        "followed_artists", "user_id string, artist_id string, processed_at timestamp",
        key=("user_id", "artist_id"), partition_by=("user_id",), description="Followed artists"),
    TableSpec(
        "top_tracks",
        "user_id string, ith_preference int, track_id string, track_name string, artists_id string, "
        "album_id string, track_popularity int, explicit boolean, duration_ms bigint, processed_at timestamp",
        key=("user_id", "track_id", "ith_preference"), sort=("ith_preference",), partition_by=("user_id",),
        description="Ranked top tracks"),
    TableSpec(
        "artists_catalog",
        "id string, name string, popularity int, followers bigint, genres array<string>, "
        "followers_tier string, processed_at timestamp, data_source string, popularity_range string, "
        "primary_genre string",
        key=("id",), partition_by=("popularity_range", "primary_genre"), description="Artist catalog"),
]}
