"""Day folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netwatch.functions.times import parse_time
from netwatch.operators.filters import valid_days
from netwatch.schema import DAY_PARTS

# White space around values is part of them.
WRITE_OPTIONS = {
    "csv": {
        "header": "true",
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
}
LINE_BREAK = r"[\r\n]"


def write_by_day(
    raw: DataFrame, base: str, fmt: str = "csv", overwrite: str | None = None
) -> DataFrame:
    """Writes text records below ``year=/month=/day=`` and returns the rejected ones.

    Values are written as they came. Lines of CSV cannot hold a value with a line break, so records with
    one are rejected there, like those without a valid day. ``overwrite`` is None to append, ``"dynamic"`` to replace just
    the days present in the frame, ``"static"`` to replace the whole folder. Before the write, rows
    are brought together by day with the sizes seen at run time: small days share a task and a
    day that holds much of the data is split over several.
    """
    kept, rejected = valid_days(raw)
    if fmt == "csv":
        broken = reduce(Column.__or__, (F.coalesce(F.col(c).cast("string").rlike(LINE_BREAK), F.lit(False)) for c in raw.columns))
        kept, rejected = kept.filter(~broken), rejected.unionByName(kept.filter(broken))
    time = parse_time(F.col("timestamp"))
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    dated = kept.select("*", *(F.date_format(time, p).alias(name) for name, p in parts.items()))
    writer = dated.hint("rebalance", *DAY_PARTS).write.format(fmt).partitionBy(*DAY_PARTS)
    writer = writer.options(**WRITE_OPTIONS.get(fmt, {}))
    if overwrite:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", overwrite)
    else:
        writer = writer.mode("append")
    writer.save(base)
    return rejected


def write_view(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Writes a result in columnar form."""
    df.write.mode(mode).parquet(path)
