"""Scalar column functions for the event model: mapping, ids, hashing, time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwheel.schemas import ACTION_TO_EVENT_TYPE


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_action(action: str | Column = "product_action") -> Column:
    """detail/add/remove/purchase -> standard event type; anything else -> null."""
    action = col_of(action)
    mapped = None
    for raw, standard in ACTION_TO_EVENT_TYPE:
        cond = action == F.lit(raw)
        mapped = F.when(cond, F.lit(standard)) if mapped is None else mapped.when(cond, F.lit(standard))
    return mapped


def click_event_id(
    session: str = "session_id_hash",
    raw_type: str = "event_type",
    action: str = "product_action",
    sku: str = "product_sku_hash",
    epoch_ms: str = "server_timestamp_epoch_ms",
    url: str = "hashed_url",
) -> Column:
    """Deterministic id: sha-256 hex of the raw fields joined by '||' (nulls skipped).

    Exact duplicate rows get the same id on purpose, which is what Silver dedups on.
    """
    return F.sha2(
        F.concat_ws(
            "||",
            F.col(session),
            F.col(raw_type),
            F.col(action),
            F.col(sku),
            F.col(epoch_ms).cast("string"),
            F.col(url),
        ),
        256,
    )


def session_bucket(modulus: int, column: str = "session_id") -> Column:
    """Stable, never negative bucket of a session: pmod(xxhash64(session), modulus)."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(modulus).cast("bigint"))


def epoch_ms_to_ts(column: str | Column) -> Column:
    return F.timestamp_millis(col_of(column))


def utc_date(column: str | Column) -> Column:
    """Calendar date of a timestamp (the session zone is UTC)."""
    return F.to_date(col_of(column))


def as_ntz(column: str | Column) -> Column:
    """Wall-clock (UTC) timestamp without zone, for results compared across engines."""
    return col_of(column).cast("timestamp_ntz")
