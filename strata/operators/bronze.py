"""Bronze layer (P1-P7): trim, rename, typed casts, blank tracking and lineage in ONE projection.

Blank semantics of the tracked numeric column (``total_charges``):

* ``blank_mode="default"``: a value is blank when it is NULL or empty after trimming spaces. This tracks both
  whitespace-only fields and empty fields (which Spark's CSV reader turns into NULL).
* ``blank_mode="strict"``: blank only when ``trim(raw) == ""``. Empty CSV fields arrive as NULL, so the flag is
  NULL for them and true only for whitespace-only fields (three-valued, like the reference).

Casts use ``try_cast``: under ANSI mode (Spark 4 default) a malformed number becomes NULL instead of failing the
job. Note ``try_cast('5.7' as int)`` is NULL (not 5).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.spec import SUBSCRIBER, SubscriberSpec


def run_timestamp() -> _dt.datetime:
    """One timestamp per run, passed to every layer as a literal (not ``current_timestamp()`` per action)."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _ts_literal(ts) -> Column:
    if ts is None:
        return F.current_timestamp()
    if isinstance(ts, Column):
        return ts
    return F.lit(ts).cast("timestamp")


def blank_flag(trimmed: Column, blank_mode: str = "default") -> Column:
    if blank_mode == "strict":
        return trimmed == F.lit("")
    if blank_mode == "default":
        return F.coalesce(trimmed, F.lit("")) == F.lit("")
    raise ValueError(f"unknown blank_mode {blank_mode!r}")


def to_bronze(
    raw: DataFrame,
    source_path: str | None = None,
    run_ts=None,
    spec: SubscriberSpec = SUBSCRIBER,
    blank_mode: str = "default",
    source_from_metadata: bool = False,
) -> DataFrame:
    """Raw all-string frame -> bronze frame (25 columns for the subscriber spec), a single narrow projection.

    ``source_file`` is the given ``source_path`` literal, or the physical file of each row when
    ``source_from_metadata`` is set (file sources only).
    """
    trimmed = {c: F.trim(F.col(c)) for c in spec.raw_columns}
    renamed = {spec.renames.get(c, c): expr for c, expr in trimmed.items()}
    out: dict[str, Column] = {}
    for name, expr in renamed.items():
        if name in spec.int_columns:
            expr = expr.try_cast("int")
        elif name in spec.double_columns:
            expr = expr.try_cast("double")
        elif name == spec.blank_tracked:
            expr = F.nullif(expr, F.lit("")).try_cast("double")
        out[name] = expr
    tracked_raw = renamed[spec.blank_tracked]
    out[f"{spec.blank_tracked}_raw"] = tracked_raw
    out[f"{spec.blank_tracked}_was_blank"] = blank_flag(tracked_raw, blank_mode)
    if source_from_metadata:
        out["source_file"] = F.col("_metadata.file_path")
    else:
        out["source_file"] = F.lit(source_path).cast("string")
    out["ingested_at_utc"] = _ts_literal(run_ts)
    return raw.select(*[expr.alias(name) for name, expr in out.items()])
