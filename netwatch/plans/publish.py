"""Views written to the stores: as cells to the wide-column one, as points to the time-series one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame

from netwatch.operators.shaping import to_cells, to_points
from netwatch.sinks.committed import FileStore, write_committed
from netwatch.sinks.stores import CELL_BATCH, POINT_BATCH, Client, fan_out, write_partitions

# Column family and columns of each view's cells; qualifiers are named like the columns.
CELLS = {
    "ip_reputation": ("info", ("total_requests", "threat_count", "threat_score", "risk_level")),
    "attack_patterns": ("stats", ("attack_count", "last_seen")),
    "threat_timeline": ("data", ("event_count", "total_bytes")),
}

# Tags, fields and time of each view's points; the measurement is named like the view.
POINTS = {
    "ip_reputation": (("source_ip",), ("total_requests", "threat_count"), "detection_date"),
    "attack_patterns": (("attack_type",), ("attack_count",), "detection_date"),
    "threat_timeline": (("threat_label",), ("event_count",), "hour"),
}


def view_cells(view: DataFrame, name: str) -> DataFrame:
    """Cells of a view; columns that this variant of the view does not have are left out."""
    family, columns = CELLS[name]
    return to_cells(view, "row_key", family, {c: c for c in columns if c in view.columns})


def view_points(view: DataFrame, name: str, as_of: dt.datetime | str | None = None) -> DataFrame:
    """Points of a view, with the time of the query, or ``as_of``, where a row or the whole view has none."""
    tags, fields, time = POINTS[name]
    return to_points(view, name, tags, fields, time if time in view.columns else None, as_of)


def publish(
    view: DataFrame,
    name: str,
    cell_client: Callable[[], Client] | None = None,
    point_client: Callable[[], Client] | None = None,
    as_of: dt.datetime | str | None = None,
) -> None:
    """Writes a view to the stores that a client is given for; any failure is raised."""
    sinks: list[Callable[[DataFrame], None]] = []
    if cell_client:
        sinks.append(lambda df: write_partitions(view_cells(df, name), cell_client, CELL_BATCH))
    if point_client:
        sinks.append(lambda df: write_partitions(view_points(df, name, as_of), point_client, POINT_BATCH))
    fan_out(view, sinks)


def publish_files(view: DataFrame, name: str, root: str, run: str, as_of: dt.datetime | str | None = None) -> None:
    """Writes a view's cells and points to file stores below ``root``, each as a run that replaces one of the same name."""
    fan_out(
        view,
        [
            lambda df: write_committed(view_cells(df, name), partial(FileStore, f"{root}/cells"), f"{name}-{run}"),
            lambda df: write_committed(view_points(df, name, as_of), partial(FileStore, f"{root}/points"), f"{name}-{run}"),
        ],
    )
