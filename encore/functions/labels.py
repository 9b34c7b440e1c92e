"""Bucketing and label expressions.

All are plain ``when`` chains / map lookups so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier names, thresholds and display labels used by the reference.
POPULARITY_TIERS = ["emergent", "growing", "established"]          # <=40, <=70, else
POPULARITY_RANGES = ["very_high", "high", "medium", "low", "very_low"]  # >=80, >=60, >=40, >=20, else
FOLLOWER_TIERS = ["mega", "major", "established", "emerging", "niche"]  # >=10M, >=1M, >=100K, >=10K, else
DAY_TYPES = ["weekday", "weekend"]
TASTE_LABELS = {
    "emergent": "Descubridor Underground",
    "growing": "Explorador Equilibrado",
    "established": "Amante del Mainstream",
    "unknown": "Explorador",
}
TASTE_DEFAULT = "Explorador"
ACTIVITY_LEVELS = ["Muy Activo", "Activo", "Moderado", "Casual"]    # plays/day >50, >20, >5, else
PREFERENCE_WEEKEND = "fin de semana"
PREFERENCE_WEEKDAY = "días laborales"
NO_GENRES = "No genres"
NO_ARTIST = "No disponible"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def popularity_tier(p) -> Column:
    p = _c(p)
    return F.when(p <= 40, "emergent").when(p <= 70, "growing").otherwise("established")


def tier_ordinal(t) -> Column:
    """Position of a popularity tier in dict order (tie-break for T12)."""
    t = _c(t)
    return F.when(t == "emergent", 0).when(t == "growing", 1).otherwise(2)


def popularity_range(p) -> Column:
    p = _c(p)
    return (F.when(p >= 80, "very_high").when(p >= 60, "high").when(p >= 40, "medium")
            .when(p >= 20, "low").otherwise("very_low"))


def followers_tier(f) -> Column:
    f = _c(f)
    return (F.when(f >= 10_000_000, "mega").when(f >= 1_000_000, "major").when(f >= 100_000, "established")
            .when(f >= 10_000, "emerging").otherwise("niche"))


def is_weekend(dow) -> Column:
    return _c(dow).isin(1, 7)


def day_type(dow) -> Column:
    return F.when(is_weekend(dow), "weekend").otherwise("weekday")


def valid_range(x, lo: float = 0, hi: float = 100) -> Column:
    """Value as DOUBLE when inside [lo, hi], else NULL (P20)."""
    d = _c(x).cast("double")
    return F.when(d.between(lo, hi), d)


def decile_floor(p, default: int = 50) -> Column:
    """int(p / 10) * 10 with a default for missing popularity."""
    return (F.floor(F.coalesce(_c(p), F.lit(default)) / 10) * 10).cast("int")


def join_or(arr, empty_text: str = NO_GENRES, sep: str = ", ") -> Column:
    """', '.join(list) or a fallback text for NULL/empty lists."""
    a = _c(arr)
    return F.when(F.size(F.coalesce(a, F.array().cast("array<string>"))) > 0, F.array_join(a, sep)).otherwise(empty_text)


def hour_label(h) -> Column:
    return F.format_string("%02d:00", _c(h))


def taste_label(tier) -> Column:
    m = F.create_map(*[F.lit(x) for kv in TASTE_LABELS.items() for x in kv])
    return F.coalesce(F.element_at(m, _c(tier)), F.lit(TASTE_DEFAULT))


def activity_level(plays, days) -> Column:
    plays, days = _c(plays), _c(days)
    per_day = plays.cast("double") / days
    return (F.when(F.coalesce(days, F.lit(0)) == 0, "Casual")
            .when(per_day > 50, "Muy Activo").when(per_day > 20, "Activo")
            .when(per_day > 5, "Moderado").otherwise("Casual"))


def listening_preference(weekend_pct) -> Column:
    """Weekend share, rounded to one decimal like the reference, above 60 -> weekend."""
    return F.when(F.bround(_c(weekend_pct), 1) > 60, PREFERENCE_WEEKEND).otherwise(PREFERENCE_WEEKDAY)


def pct(num, den) -> Column:
    """num * 100 / den as DOUBLE, 0 when the denominator is 0 or NULL."""
    num, den = _c(num), _c(den)
    return F.when(F.coalesce(den, F.lit(0)) > 0, num.cast("double") / den * 100).otherwise(F.lit(0.0))


def lenient_numeric_ok(c) -> Column:
    """Aggregate: TRUE when every non-null value of a text column parses as a number (P25)."""
    c = _c(c)
    return F.bool_and(c.isNull() | c.try_cast("double").isNotNull())


def strict_numeric(c) -> Column:
    return F.coalesce(_c(c).try_cast("double"), F.lit(0.0))
