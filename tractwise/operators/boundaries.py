"""Boundary generalisation as a table operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from tractwise.columns import BOUNDARY_TOLERANCE_M
from tractwise.functions.geometry import polygons_from_wkt, simplified
from tractwise.functions.topology import simplified_together
from tractwise.functions.wkb import polygons_from_wkb


def _arrays(df: DataFrame, geom: str, output: str) -> tuple[DataFrame, str]:
    """``df`` and the column that holds the shapes as arrays: ``output``, where ``geom`` is text or binary."""
    kind = df.schema[geom].dataType
    if isinstance(kind, T.StringType):
        return df.withColumn(output, polygons_from_wkt(geom)), output
    if isinstance(kind, T.BinaryType):
        return df.withColumn(output, polygons_from_wkb(geom)), output
    return df, geom


def simplify_boundaries(
    df: DataFrame, geom: str, *, tolerance_m: float = BOUNDARY_TOLERANCE_M, output: str | None = None
) -> DataFrame:
    """Generalise the shapes in ``geom``: nested arrays of ``{lon, lat}`` points, or
    polygons as well-known text or binary. No dropped vertex lies farther than
    ``tolerance_m`` from what remains. The result is always arrays."""
    output = output or geom
    df, geom = _arrays(df, geom, output)
    return df.withColumn(output, simplified(df, geom, tolerance_m))


def simplify_coverage(
    df: DataFrame, geom: str, *, tolerance_m: float = BOUNDARY_TOLERANCE_M, output: str | None = None
) -> DataFrame:
    """Generalise shapes that touch, so that they still touch: no gaps and no overlaps along shared borders.

    Borders are parted at junctions, vertices whose neighbours differ between the lines
    through them. Junctions stay; what lies between two of them is simplified from the
    same points in the same direction wherever it occurs, so all shapes along it keep the
    same vertices. Shapes share a border if they list the same coordinates.

    ``geom`` as for ``simplify_boundaries``. A NULL shape stays NULL, repeated rows and equal
    shapes are each simplified, lines that do not close keep their ends, and a shape
    smaller than the tolerance may shrink to its junctions.
    """
    output = output or geom
    df, geom = _arrays(df, geom, output)
    return simplified_together(df, geom, output, tolerance_m)
