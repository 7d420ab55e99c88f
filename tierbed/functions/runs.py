"""Run ids and run-scoped paths."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters that Spark encodes in partition directories.
ENCODED = re.compile(r"[\x01-\x1F\x7F\"#%'*/:=?\\{\[\]^]")


def new_run_id() -> str:
    """Run id of this instant, in UTC, for example ``20260228T120000``."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")


def run_id_text(ts: Column | str) -> Column:
    """The run id format as a column expression: UTC for an instant, as it stands for a
    timestamp without time zone. The session's time zone plays no part in either."""
    column = F.col(ts) if isinstance(ts, str) else ts
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    micros = F.unix_micros(column.cast("timestamp"))
    in_utc = epoch + F.make_dt_interval(secs=micros.cast("decimal(24,6)") / F.lit(1_000_000))
    wall = F.when(F.typeof(column) == "timestamp_ntz", column.cast("string")).otherwise(in_utc.cast("string"))
    digits = F.translate(F.substring(wall, 1, 19), "-:", "")
    return F.translate(digits, " ", "T")


def run_path(prefix: str, run_id: str) -> str:
    """Directory of one run. The Hive-style name lets Spark discover ``run_id``.

    Characters are percent-encoded as ``partitionBy`` does it, so that a run's directory is the
    same whichever of the two wrote it; Spark decodes them again.
    """
    name = ENCODED.sub(lambda m: f"%{ord(m[0]):02X}", run_id)
    return f"{prefix.rstrip('/')}/run_id={name}"
