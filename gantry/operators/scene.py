"""Transforms of a scene graph: 4x4 matrices composed along parent links, and points and normals under them.

A matrix is an array of 16 doubles, row by row; a node's place in the world is the product from its root down to it, in
that order. Products along a chain are made by doubling: in each round every node takes its reach's product in front of its
own and reaches twice as far, so a chain of any depth takes the logarithm of its length in rounds, each a join on ids.

A node whose parent is NULL or unknown is a root. Several rows of one id, and loops of parents, raise. A matrix that is NULL
is the identity; one of another length raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gantry.operators.durable import written

#: Fixed value: from the source's axes (z up, x mirrored) to those of the asset table: (x, y, z) goes to (-x, z, y).
ASSET_FROM_SOURCE = [-1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
IDENTITY = [float(i % 5 == 0) for i in range(16)]


def product(a: Column, b: Column) -> Column:
    """a times b."""
    return F.array(*[sum((a[4 * i + k] * b[4 * k + j] for k in range(1, 4)), a[4 * i] * b[j]) for i in range(4) for j in range(4)])


def constant(m: list[float]) -> Column:
    return F.array(*[F.lit(x) for x in m])


def world_transforms(nodes: DataFrame) -> DataFrame:
    """(id, transform) of nodes (id, parent, transform)."""
    own = F.coalesce("transform", constant(IDENTITY))
    own = F.when(F.size(own) == 16, own).otherwise(F.raise_error(F.lit("a transform has not 16 numbers")))
    state = nodes.select("id", "parent", own.alias("transform"))
    known = nodes.groupBy(F.col("id").alias("known")).agg(F.count("*").alias("n"))
    once = F.when(F.col("n") == 1, F.col("known")).otherwise(F.raise_error(F.lit("an id has several rows")))
    state = written(state.join(known.select("known", once.alias("up")), F.col("parent") == F.col("known"), "left").select("id", "up", "transform"))
    n, reach = state.count(), 1
    if n != known.count():
        raise ValueError("an id has several rows")
    while not state.where("up IS NOT NULL").isEmpty():
        if reach > n:
            raise ValueError("the parents of some node form a loop")
        above = state.select(F.col("id").alias("at"), F.col("up").alias("far"), F.col("transform").alias("over"))
        far = state.join(above, F.col("up") == F.col("at"), "left")
        made = F.when(F.col("over").isNull(), F.col("transform")).otherwise(product(F.col("over"), F.col("transform")))
        state = written(far.select("id", F.col("far").alias("up"), made.alias("transform")))
        reach *= 2
    return state.select("id", "transform")


def moved(point: list[Column], m: Column) -> list[Column]:
    """x, y and z of a point under a matrix."""
    return [m[4 * i] * point[0] + m[4 * i + 1] * point[1] + m[4 * i + 2] * point[2] + m[4 * i + 3] for i in range(3)]


def turned(normal: list[Column], m: Column) -> list[Column]:
    """A normal under a matrix's turn alone, its length 1 again; one of length 0 stays. For turns and mirrors, not for uneven scales."""
    out = [m[4 * i] * normal[0] + m[4 * i + 1] * normal[1] + m[4 * i + 2] * normal[2] for i in range(3)]
    size = F.sqrt(out[0] * out[0] + out[1] * out[1] + out[2] * out[2])
    return [x / F.when(size == 0, 1.0).otherwise(size) for x in out]


def in_asset_axes(nodes: DataFrame, vertices: DataFrame) -> DataFrame:
    """vertices (id, x, y, z, nx, ny, nz, ...) of nodes, their points and normals in the world and in the axes of the asset table."""
    world = world_transforms(nodes).select(F.col("id").alias("of"), product(constant(ASSET_FROM_SOURCE), F.col("transform")).alias("m"))
    met = vertices.join(world, F.col("id") == F.col("of"))
    point, normal = moved([F.col(c) for c in "xyz"], F.col("m")), turned([F.col(c) for c in ("nx", "ny", "nz")], F.col("m"))
    return met.withColumns(dict(zip(("x", "y", "z", "nx", "ny", "nz"), point + normal, strict=True))).drop("of", "m")
