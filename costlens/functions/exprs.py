"""Reusable column expressions.

Everything here returns a ``Column`` built from built-in functions, so it stays
inside whole-stage code generation; no Python UDF is used anywhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AsOf:
    """The 'now' of a run. The models read the clock; here it is a parameter."""

    ts: str = "2024-01-31 00:00:00"

    @property
    def date(self) -> str:
        return self.ts[:10]

    def ts_sql(self, engine: str = "spark") -> str:
        return f"TIMESTAMP_NTZ '{self.ts}'" if engine == "spark" else f"TIMESTAMP '{self.ts}'"

    def date_sql(self, engine: str = "spark") -> str:
        return f"DATE '{self.date}'"

    def ts_col(self) -> Column:
        return F.expr(self.ts_sql())

    def date_col(self) -> Column:
        return F.expr(self.date_sql())

    @property
    def datetime(self) -> datetime:
        return datetime.fromisoformat(self.ts)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: The day a row of a date-laid table is stored under (``streaming.daily``).
DAY = "load_day"


def since(df, ts: str, bound: Column):
    """Rows of ``ts`` at or after ``bound``. Where the table is laid out by the day of
    ``ts``, the bound is put on the day too, so older folders are not read."""
    rows = df.filter(F.col(ts) >= bound)
    return rows.filter(F.col(DAY) >= F.to_date(bound)) if DAY in df.columns else rows


def safe_divide(num, den) -> Column:
    """num / NULLIF(den, 0); NULL when the denominator is 0 or NULL."""
    d = col(den)
    return col(num) / F.when(d != 0, d)


def days_between(start, end) -> Column:
    """Day boundaries crossed from start to end (truncate both, then subtract)."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_seconds(c) -> Column:
    """Seconds since 1970-01-01 of a wall-clock timestamp, independent of the
    session time zone."""
    return F.timestamp_diff("SECOND", F.expr(_EPOCH), col(c).cast("timestamp_ntz"))


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from start to end."""
    return (F.floor(epoch_seconds(end) / 60) - F.floor(epoch_seconds(start) / 60)).cast("long")


def seconds_between(start, end) -> Column:
    return (epoch_seconds(end) - epoch_seconds(start)).cast("long")


def weeks_between(start, end) -> Column:
    """Week boundaries crossed (weeks start on Monday)."""
    return (F.datediff(F.date_trunc("week", col(end)).cast("date"),
                       F.date_trunc("week", col(start)).cast("date")) / 7).cast("long")


def months_between_boundaries(start, end) -> Column:
    s, e = col(start), col(end)
    return ((F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)).cast("long")


def dow_sun0(c) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(col(c)) - 1).cast("long")


def greatest_strict(*cols) -> Column:
    """GREATEST that returns NULL if any argument is NULL."""
    cs = [col(c) for c in cols]
    anynull = cs[0].isNull()
    for c in cs[1:]:
        anynull = anynull | c.isNull()
    return F.when(~anynull, F.greatest(*cs))


def least_strict(*cols) -> Column:
    cs = [col(c) for c in cols]
    anynull = cs[0].isNull()
    for c in cs[1:]:
        anynull = anynull | c.isNull()
    return F.when(~anynull, F.least(*cs))


def not_like_any(c, prefixes) -> Column:
    """LOWER(c) NOT LIKE 'p%' for every prefix (NULL text gives NULL). One match at the
    start of the text, of which only so much is lowered as the longest prefix needs:
    filters do not share the lowered text between the terms of a condition."""
    start = F.lower(F.left(col(c), F.lit(max(map(len, prefixes)))))
    return ~start.rlike(rf"\A(?:{'|'.join(map(re.escape, prefixes))})")


# FIXED VALUES: statement prefixes the models treat as internal, not user work.
INTERNAL_PREFIXES_ATTRIBUTION = [
    "execute streamlit", "execute dbt", "create or replace", "alter", "grant", "call",
]
INTERNAL_PREFIXES_STAGING = ["execute streamlit", "execute dbt"]
INTERNAL_PREFIXES_LONG_RUNNING = ["execute streamlit", "execute dbt", "create or replace", "call"]
INTERNAL_PREFIXES_UNION = [
    "execute streamlit", "execute dbt project", "execute dbt", "create or replace", "alter", "grant", "call",
]
# system schemas whose queries cannot be tuned by users
SYSTEM_TEXT_MARKERS = ["SNOWFLAKE.ORGANIZATION_USAGE", "SNOWFLAKE.ACCOUNT_USAGE"]
SYSTEM_DATABASE = "SNOWFLAKE"

# FIXED VALUES: credits per hour by warehouse size name (upper-cased lookup).
SIZE_CREDITS = [
    ("X-SMALL", 1), ("XSMALL", 1), ("SMALL", 2), ("MEDIUM", 4), ("LARGE", 8),
    ("X-LARGE", 16), ("XLARGE", 16), ("2X-LARGE", 32), ("2XLARGE", 32),
    ("3X-LARGE", 64), ("3XLARGE", 64), ("4X-LARGE", 128), ("4XLARGE", 128),
    ("5X-LARGE", 256), ("5XLARGE", 256), ("6X-LARGE", 512), ("6XLARGE", 512),
]


def size_credits_per_hour(size) -> Column:
    """Literal map lookup (no join); unknown and NULL sizes give 1."""
    m = F.create_map(*[x for k, v in SIZE_CREDITS for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, F.upper(col(size))), F.lit(1))


def not_system_query(df_text="query_text", db="database_name") -> Column:
    """Common exclusion: system database and texts naming the usage schemas."""
    text = F.upper(col(df_text))
    cond = F.coalesce(col(db), F.lit("")) != SYSTEM_DATABASE
    for m in SYSTEM_TEXT_MARKERS:
        cond = cond & ~text.contains(m)
    return cond


def tag_team(tag) -> Column:
    """Team from a structured tag ``team:<name>;...``; NULL when absent."""
    t = col(tag)
    return F.when(t.like("team:%"),
                  F.split_part(F.split_part(t, F.lit("team:"), F.lit(2)), F.lit(";"), F.lit(1)))


def role_team_staging(role) -> Column:
    """Team from the role name, staging rule list (first match wins)."""
    r = F.upper(col(role))
    return (F.when(r.like("%ADMIN%"), "Platform")
            .when(r.like("%ANALYST%"), "Analytics")
            .when(r.like("%ENGINEER%"), "Engineering")
            .when(r.like("%TRANSFORM%"), "Data Engineering")
            .otherwise("Unassigned"))


def role_team_attribution(role) -> Column:
    """Team from the role name, attribution rule list; NULL when no rule fires."""
    raw = col(role)
    r = F.upper(raw)
    return (F.when(r.like("%ADMIN%") | (raw == "ACCOUNTADMIN"), "Platform")
            .when(r.like("%ANALYST%"), "Analytics")
            .when(r.like("%ENGINEER%"), "Engineering")
            .when(r.like("%TRANSFORM%"), "Data Engineering")
            .when(raw == "SYSADMIN", "Platform")
            .when(raw == "PUBLIC", "Unassigned")
            .when(r.like("%TENSOR%"), "AI/ML"))


def warehouse_team(wh) -> Column:
    w = F.upper(col(wh))
    return (F.when(w.like("%ANALYTICS%"), "Analytics")
            .when(w.like("%ETL%"), "Data Engineering")
            .when(w.like("%COST_OPT%"), "Cost Optimization")
            .when(w.like("%LEARNING%"), "Training")
            .otherwise("Unassigned"))


def confidence_weight(c) -> Column:
    return F.when(col(c) == "HIGH", 3).when(col(c) == "MEDIUM", 2).otherwise(1)


def effort_weight(c) -> Column:
    return F.when(col(c) == "LOW", 1).when(col(c) == "MEDIUM", 2).otherwise(3)


def priority(savings, confidence, effort) -> Column:
    return col(savings) * confidence_weight(confidence) / effort_weight(effort)


def floor_double(c) -> Column:
    """Floor that stays a double: no way through a 64-bit integer for NaN and for
    values of 2^53 and more, which are whole already."""
    return F.when(F.abs(c) < float(1 << 53), F.floor(c).cast("double")).otherwise(c.cast("double"))


def round4(c) -> Column:
    """Round half up to 4 places by a plain float formula (the same formula is
    used by the oracle, so both engines agree bit for bit). Values sitting on a
    half boundary are nudged by 1e-10 relative first, so last-bit differences
    of summation order cannot flip them."""
    c = col(c)
    return (floor_double((c + F.abs(c) * 1e-10) * 10000 + 0.5) / 10000).cast("double")


def round_half_up(c, digits: int) -> Column:
    scale = 10 ** digits
    return (floor_double(col(c).cast("double") * scale + 0.5) / scale).cast("double")


def fmt1(c) -> Column:
    """Number rendered with one decimal (text columns only)."""
    return F.format_string("%.1f", col(c).cast("double"))
