"""Connected components of an edge table: trees inside pieces of it, then rounds of large and small stars."""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from evrange.llm.common import staged

PIECE = 100_000     # edges that a task gathers into trees
#: Types that Python orders as Spark does.
_ORDERED = (T.LongType(), T.IntegerType(), T.StringType(), T.BinaryType())


def _state(edges: DataFrame) -> tuple[bool, int]:
    """Has every node u one neighbour, which is no u itself (another round would change nothing then)? And the number of edges."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("w"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                         F.struct(F.col("v").alias("w"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    nodes = ends.groupBy("w").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    wrong, n = nodes.agg(F.count_if(F.expr("up > 1 OR up = 1 AND down = 1")), F.sum("up")).first()
    return wrong == 0, n or 0


def _trees(piece: int):
    """Rows (u, v) to (u, least node that it is connected with by the rows of the task), as far as `piece` nodes are held."""
    def run(batches):
        above = {}

        def root(x):
            while (up := above.get(x, x)) != x:
                above[x] = x = above.get(up, up)
            return x

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(above, kind), pa.array(map(root, list(above)), kind)], ["u", "v"])

        for batch in batches:
            kind = batch.schema.types[0]
            for u, v in zip(*(c.to_pylist() for c in batch.columns)):
                u, v = root(u), root(v)
                if u != v:
                    above[max(u, v)] = min(u, v)
            if len(above) > piece:
                yield packed()
                above.clear()
        if above:
            yield packed()
    return run


def stars(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(u, v): every node that has a smaller one in its component, with the smallest.

    `edges` may hold repeated edges, either direction, loops and nulls (both of which say
    nothing). Nodes are only compared, so any orderable type does. Nodes that are numbers, text
    or bytes are first gathered into trees in pieces of PIECE edges, as many as there are; with
    one piece that is all. A round points every node past its neighbour to that one's least
    neighbour, then gathers the neighbours of a node under the least of them; the number of
    rounds grows with the logarithm of the longest chain. Each half round is written to the
    checkpoint folder. No edge reaches the driver.
    """
    edges = staged(edges.where(F.col(a) != F.col(b))
                   .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    done, n = _state(edges)
    kind = edges.schema["u"].dataType
    if not done and kind in _ORDERED:
        pieces = -(-n // PIECE)
        trees = edges.coalesce(pieces).mapInArrow(_trees(PIECE), T.StructType([T.StructField("u", kind), T.StructField("v", kind)]))
        if pieces == 1:
            return staged(trees)
        edges = staged(trees.distinct())
        done, _ = _state(edges)
    while not done:
        least = staged(edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")))
        large = staged(edges.join(least, edges.v == least.w, "left")
                       .select("u", F.coalesce("m", "v").alias("v")).distinct())
        least = staged(large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")))
        small = large.join(least, large.u == least.w).where(F.col("v") != F.col("m"))
        edges = staged(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .unionAll(least.select(F.col("w"), F.col("m"))).distinct())
        done, _ = _state(edges)
    return edges
