"""Technical columns every staged row carries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultspan.types import ID


def date_number(day: Column) -> Column:
    """A date as the number yyyymmdd."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def stamp(moment: datetime) -> Column:
    """A wall-clock time in the session's time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def technical_columns(source: str, object_id: int, run_ts: datetime, run_id: str) -> dict[str, Column]:
    """Load time, load version, object id, source name, run id and free description."""
    return {
        "ts_stg": stamp(run_ts),
        "vr_stg": date_number(F.lit(run_ts.date())).cast(ID),
        "id_obj_tec": F.lit(object_id).cast(ID),
        "cd_src": F.lit(source),
        "cd_pid": F.lit(run_id),
        "lb_dsc": F.lit(None).cast("string"),
    }
