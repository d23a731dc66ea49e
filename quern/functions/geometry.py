"""Geometries as a struct of well-known binary (wkb) and coordinate system (crs), with text and extent.

Spark moves the bytes; only reading them takes Python, in Arrow batches.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.registry import col, register

#: Kinds of geometry by their code in well-known binary: fixed values.
KINDS = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON", 7: "GEOMETRYCOLLECTION"}


def _read(raw: bytes, at: int = 0) -> tuple[int, object, int]:
    """(kind, content, place after it): a point's coordinates, or a list of points, of rings or of (kind, content) parts."""
    order = "<" if raw[at] else ">"
    kind = struct.unpack_from(order + "I", raw, at + 1)[0]
    dims = 2 + (kind // 1000 in (1, 2)) + 2 * (kind // 1000 == 3)
    kind, at = kind % 1000, at + 5

    def points(n: int, at: int) -> tuple[list[tuple[float, ...]], int]:
        flat = struct.unpack_from(f"{order}{n * dims}d", raw, at)
        return [flat[i : i + dims] for i in range(0, len(flat), dims)], at + 8 * n * dims

    if kind == 1:
        own, at = points(1, at)
        return kind, own[0], at
    n = struct.unpack_from(order + "I", raw, at)[0]
    at += 4
    if kind == 2:
        own, at = points(n, at)
        return kind, own, at
    parts = []
    for _ in range(n):
        if kind == 3:
            part, at = points(struct.unpack_from(order + "I", raw, at)[0], at + 4)
        else:
            inner, content, at = _read(raw, at)
            part = (inner, content)
        parts.append(part)
    return kind, parts, at


def _number(x: float) -> str:
    return str(int(x)) if x == int(x) else repr(x)


def _body(kind: int, content) -> str:
    if kind == 1:
        return " ".join(map(_number, content))
    if kind == 2:
        return ", ".join(_body(1, p) for p in content)
    if kind == 3:
        return ", ".join(f"({_body(2, ring)})" for ring in content)
    if kind == 4:
        return ", ".join(_body(*p) for p in content)
    return ", ".join(f"({_body(*p)})" for p in content) if kind < 7 else ", ".join(_text(*p) for p in content)


def _empty(kind: int, content) -> bool:
    return (content[0] != content[0]) if kind == 1 else not content


def _text(kind: int, content) -> str:
    return f"{KINDS[kind]} EMPTY" if _empty(kind, content) else f"{KINDS[kind]} ({_body(kind, content)})"


def _points(kind: int, content):
    if kind == 1:
        yield from () if _empty(kind, content) else (content,)
    elif kind == 2:
        yield from content
    else:
        for part in content:
            yield from part if kind == 3 else _points(*part)


@F.pandas_udf(T.StringType())
def _as_text(wkb: pd.Series) -> pd.Series:
    return wkb.map(lambda b: None if b is None else _text(*_read(b)[:2]))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _extent(wkb: pd.Series) -> pd.Series:
    """Least x, least y, largest x, largest y; null for an empty geometry."""

    def one(raw: bytes | None) -> list[float] | None:
        found = [] if raw is None else list(_points(*_read(raw)[:2]))
        if not found:
            return None
        xs, ys = [p[0] for p in found], [p[1] for p in found]
        return [min(xs), min(ys), max(xs), max(ys)]

    return wkb.map(one)


@register()
def st_geomfromwkb(b):
    return F.when(col(b).isNotNull(), F.struct(col(b).alias("wkb"), F.lit(None).cast("string").alias("crs")))


@register("st_aswkb", "st_asbinary")
def st_aswkb(g):
    return col(g)["wkb"]


@register("st_astext", "st_aswkt")
def st_astext(g):
    return _as_text(col(g)["wkb"])


@register()
def st_crs(g):
    return col(g)["crs"]


@register()
def st_setcrs(g, crs: str):
    return col(g).withField("crs", F.lit(crs))


@register()
def st_intersects_extent(a, b):
    """Whether the rectangles around two geometries touch or overlap."""
    x, y = _extent(col(a)["wkb"]), _extent(col(b)["wkb"])
    return (x[0] <= y[2]) & (y[0] <= x[2]) & (x[1] <= y[3]) & (y[1] <= x[3])
