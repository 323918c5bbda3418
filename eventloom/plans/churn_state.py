"""Churn flags of the stored sessions, brought up to date from a state per user.

A session is flagged when it is the user's last of its day and the user's next active day is
more than ``gap_days`` later. Which sessions a run can change follows from two small tables:

* ``user_last_session``, a snapshot per day of every user's last session up to that day. A
  run reads the newest snapshot before the days it has to look at, and leaves one of its own.
* ``churn_flags``, the flagged sessions, by the day that decided it, the user's next one.

A run over new days reads those days of the session mart, the snapshot, and the days on which
a flag differs from the one stored. A run over days in the middle of the history reads the
days from there on. Only without a snapshot, the first time, all days are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.schemas import CHURN_FLAGS, SESSION_FUNNEL, USER_LAST_SESSION, as_schema
from eventloom.sources.scratch import delete_dir, new_dir
from eventloom.sources.warehouse import Warehouse

USER, DAY, SESSION = "user_pseudo_id", "session_date", "ga_session_id"


def last_of_day(sessions: DataFrame) -> DataFrame:
    """Each user's last session of each day; the others can never precede a gap."""
    return sessions.groupBy(USER, DAY).agg(F.max(SESSION).alias(SESSION))


def decided_flags(visits: DataFrame, gap_days: int) -> DataFrame:
    """Sessions followed by a gap, with the day that showed it.

    ``visits`` has at most one row per user and day, which bounds a user's window by the
    number of days.
    """
    following = F.lead(DAY).over(Window.partitionBy(USER).orderBy(DAY))
    gaps = visits.withColumn("decided_on", following).where(
        F.date_diff("decided_on", DAY) > gap_days
    )
    return as_schema(gaps, CHURN_FLAGS)


def last_sessions(visits: DataFrame, as_of: date) -> DataFrame:
    """A snapshot: each user's last session."""
    latest = F.max(F.struct(DAY, SESSION))
    rows = visits.groupBy(USER).agg(latest.alias("last")).select(USER, "last.*")
    return as_schema(rows.withColumn("as_of", F.lit(as_of)), USER_LAST_SESSION)


def _same(left: DataFrame, right: DataFrame) -> Column:
    return (
        left[USER].eqNullSafe(right[USER])
        & (left[DAY] == right[DAY])
        & (left[SESSION] == right[SESSION])
    )


def _marked(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean column: is the session among ``keys``?"""
    keys = keys.select(USER, DAY, SESSION, F.lit(True).alias(name))
    joined = rows.join(keys, _same(rows, keys), "left")
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce(keys[name], F.lit(False)).alias(name))


def _minus(rows: DataFrame, others: DataFrame) -> DataFrame:
    others = others.select(USER, DAY, SESSION)
    return rows.join(others, _same(rows, others), "left_anti")


def _copied(warehouse: Warehouse, rows: DataFrame, purpose: str) -> tuple[str, DataFrame]:
    """``rows`` written to the scratch folder: a table cannot be read while it is replaced."""
    path = new_dir(warehouse.spark, purpose)
    rows.write.parquet(path)
    return path, warehouse.spark.read.schema(rows.schema).parquet(path)


def _days_in(rows: DataFrame, column: str) -> list[date]:
    """Distinct days: one short value per calendar day reaches the driver."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


def revise_churn(
    warehouse: Warehouse, days: Sequence[date], gap_days: int, keep_snapshots: int = 3
) -> list[date]:
    """Bring the flags up to date after ``days`` of the session mart were written anew.

    Returns the days of the session mart that were rewritten. The last ``keep_snapshots``
    snapshots stay, so that the newest days can run again without reading older ones.
    """
    first = min(days)
    snapshots = warehouse.days("user_last_session")
    before = max((d for d in snapshots if d < first), default=None)
    after = lambda found: [d for d in found if before is None or d > before]
    later = after(warehouse.days("session_funnel"))
    visits = last_of_day(warehouse.read("session_funnel", later))
    if before is not None:
        state = warehouse.read("user_last_session", [before])
        visits = state.select(*visits.columns).unionByName(visits)
    path, flags = _copied(warehouse, decided_flags(visits, gap_days), "churn-flags")
    scratch = [path]
    path, snapshot = _copied(warehouse, last_sessions(visits, max(later)), "snapshot")
    scratch.append(path)

    past = after(warehouse.days("churn_flags"))
    stored = warehouse.read("churn_flags", past)
    path, gone = _copied(warehouse, _minus(stored, flags), "churn-gone")
    scratch.append(path)
    new = _minus(flags, stored)
    # Days that were written anew carry no flag yet.
    written_anew = flags.where(F.col(DAY).isin(*days))
    touched = _days_in(gone.unionByName(new).unionByName(written_anew), DAY)
    if touched:
        rows = _marked(warehouse.read("session_funnel", touched), flags, "gap")
        rows = _marked(rows, gone, "no_gap")
        flag = F.when(F.col("gap"), 1).when(F.col("no_gap"), 0).otherwise(F.col("churn_session_flag"))
        rows = as_schema(rows.withColumn("churn_session_flag", flag), SESSION_FUNNEL)
        path, fresh = _copied(warehouse, rows, "sessions")
        scratch.append(path)
        warehouse.replace_days("session_funnel", fresh, touched)

    changed = {*_days_in(flags, "decided_on"), *past}
    if changed:
        warehouse.replace_days("churn_flags", flags, sorted(changed))
    # Snapshots of days from the first on are of the state before this run.
    valid = [d for d in snapshots if d < first]
    stale = [d for d in snapshots if d not in valid[len(valid) - keep_snapshots + 1 :]]
    warehouse.replace_days("user_last_session", snapshot, [max(later)])
    warehouse.drop_days("user_last_session", [d for d in stale if d != max(later)])
    for path in scratch:
        delete_dir(warehouse.spark, path)
    return touched
