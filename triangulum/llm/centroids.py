"""Centroid clustering of integer vectors with column expressions.

Vectors become arrays of integers.  The distance to a centroid is a fold over ``zip_with``
of the vector and a literal array, the nearest centroid is the least struct (distance,
number) of an array, and new centroids are column sums grouped by cluster, combined
before the shuffle.  Only the centroids, a fixed number of rows, meet the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

CLUSTERS, DIMENSIONS, SCALE, ROUNDS = 16, 64, 64, 3
# Scaled components saturate here, so that squared distances of 64 components fit a long.
LIMIT = 1 << 27


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, as long."""
    return F.transform(
        vector, lambda x: F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), x.cast("double") * scale))).cast("long")
    )


def whole(vector: Column, dimensions: int = DIMENSIONS) -> Column:
    """True for vectors of the given length without null, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == dimensions) & ~F.coalesce(bad, F.lit(False))


def _literal(centroid: list[int]) -> Column:
    return F.expr("array(" + ", ".join(f"{c}L" for c in centroid) + ")")


def distance(vector: Column, centroid: list[int]) -> Column:
    squares = F.zip_with(vector, _literal(centroid), lambda x, c: (x - c) * (x - c))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda total, x: total + x)


def nearest(vector: Column, centroids: list[list[int]]) -> Column:
    """Struct of the least distance and its centroid; ties go to the smaller number."""
    return F.array_min(
        F.array(*[
            F.struct(distance(vector, c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)
        ])
    )


def first_centroids(vectors: DataFrame, clusters: int) -> list[list[int]]:
    """The vectors with the least sha256 of ``1:<vec_id>``; equal ids by their components, null ids last."""
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(mark.asc_nulls_last(), "vector").limit(clusters).select("vector").collect()
    return [list(r.vector) for r in rows]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor(sum / count) of each centroid's vectors; a centroid without vectors stays.

    Sums are longs, enough for 2^36 rows of the largest components; the division is exact on the driver.
    """
    dims = range(len(centroids[0]))
    near = vectors.select("vector", nearest(F.col("vector"), centroids)["cluster"].alias("cluster"))
    sums = [F.sum(F.col("vector")[i]).alias(f"s{i}") for i in dims]
    after = list(centroids)
    for row in near.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        after[row.cluster] = [int(row[f"s{i}"]) // row.n for i in dims]
    return after


def cluster(
    vectors: DataFrame,
    column: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256, one row per vector kept.

    Kept are the rows whose vector has ``dimensions`` components, none of them null or not
    finite; components beyond 2^27 / scale saturate.  Repeated rows count as often as they
    occur, null vec_ids are clustered like others and start no centroid unless ids run out,
    and fewer rows than ``clusters`` give as many centroids as rows; equal centroids leave
    all but the first empty.  An empty table gives no rows.  Columns other than vec_id and
    ``column`` are not looked at.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(whole(F.col(column), dimensions))
    rows = materialize(rows.select("vec_id", integers(F.col(column), scale).alias("vector")), "vectors")
    centroids = first_centroids(rows, clusters)
    if not centroids:
        none = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, {none}")
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    near = rows.select("vec_id", nearest(F.col("vector"), centroids).alias("_near")).select("vec_id", "_near.cluster", "_near.distance")
    near = materialize(near, "clusters")
    inertia = {r.cluster: r.d for r in near.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    per_cluster = F.array(*[F.lit(inertia.get(k, 0)).cast("long") for k in range(len(centroids))])
    marks = F.array(*[F.sha2(F.lit(",".join(map(str, c))), 256) for c in centroids])
    return near.select(
        "vec_id", "cluster", "distance",
        per_cluster[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        marks[F.col("cluster")].alias("centroid_sha256"),
    )


def oracle(clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE) -> str:
    """DuckDB SQL of the same clustering over the ``embeddings`` table."""
    steps = [
        f"""kept AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = {dimensions}
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0)""",
        f"""c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS k, v AS c
    FROM (SELECT sha256('1:' || CAST(vec_id AS VARCHAR)) AS h, v FROM kept ORDER BY h, v LIMIT {clusters}))""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""n{r} AS (
    SELECT vec_id, any_value(v) AS v, min(d) AS distance, arg_min(k, d * {clusters} + k) AS cluster
    FROM (SELECT i, vec_id, v, k, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
          FROM (SELECT row_number() OVER () AS i, vec_id, v FROM kept) CROSS JOIN c{r})
    GROUP BY i, vec_id)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (SELECT cluster, i, sum(x) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM n{r}) GROUP BY cluster, i)
    GROUP BY cluster)""")
            steps.append(f"""c{r + 1} AS (
    SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} ON m{r}.cluster = c{r}.k)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM n{rounds} JOIN c{rounds} ON cluster = k"""
