"""Vector, matrix and grid queries."""

from pyspark.sql import functions as F

from quern.operators import matrix, similarity
from quern.plans.registry import query

_M = """m AS (SELECT vec_id AS i, CAST(unnest(range(len(embedding))) AS BIGINT) AS j, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings)"""
_GRID = """g AS (SELECT CAST(p_size AS BIGINT) AS i, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS j, count(*) AS v
  FROM part GROUP BY 1, 2)"""


def entries(t):
    return matrix.coordinates(t.embeddings, "vec_id", "embedding")


def cells(t):
    return t.part.select(F.col("p_size").cast("bigint").alias("i"),
                         F.regexp_replace("p_brand", "Brand#", "").cast("bigint").alias("j"), "p_type")


@query("i01_cosine", """
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 8)
  AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def cosine(t):
    """Each vector with the next one."""
    a = t.embeddings.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x"))
    b = t.embeddings.select(F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    return a.join(b, F.col("b") == F.col("a") + 1).select(
        "a", "b", F.round(matrix.cosine(F.col("x"), F.col("y")), 8).alias("cosine"))


@query("i02_most_similar", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
 c AS (SELECT a.vec_id, b.vec_id AS nearest, list_cosine_similarity(a.v, b.v) AS cosine FROM e a JOIN e b ON a.vec_id <> b.vec_id)
SELECT vec_id, arg_max(nearest, (cosine, -nearest)) AS nearest, round(max(cosine), 8) AS cosine FROM c GROUP BY 1""")
def most_similar(t):
    return similarity.most_similar(t.embeddings, "vec_id", "embedding").withColumn("cosine", F.round("cosine", 8))


@query("i03_transpose", f"WITH {_M} SELECT j AS i, i AS j, v FROM m")
def transpose(t):
    return matrix.transpose(entries(t))


@query("i04_product", f"""
WITH {_M} SELECT a.j AS i, b.j AS j, round(sum(a.v * b.v), 8) AS v FROM m a JOIN m b ON a.i = b.i GROUP BY 1, 2""")
def product(t):
    m = entries(t)
    return matrix.product(matrix.transpose(m), m).withColumn("v", F.round("v", 8))


@query("i05_row_means", f"WITH {_M} SELECT i, round(avg(v), 10) AS mean FROM m GROUP BY 1")
def row_means(t):
    return matrix.row_means(entries(t)).withColumn("mean", F.round("mean", 10))


@query("i05_column_means", f"WITH {_M} SELECT j, round(avg(v), 10) AS mean FROM m GROUP BY 1")
def column_means(t):
    return matrix.column_means(entries(t)).withColumn("mean", F.round("mean", 10))


@query("i06_diagonal", f"""
WITH {_M}, c AS (SELECT j AS i, avg(v) AS v FROM m GROUP BY 1)
SELECT a.i, b.i AS j, round(a.v, 10) AS v FROM c a JOIN c b ON a.i = b.i""")
def diagonal(t):
    means = matrix.column_means(entries(t)).select(F.col("j").alias("i"), F.round("mean", 10).alias("v"))
    return matrix.diagonal(means)


@query("i07_covariance", f"""
WITH {_M} SELECT a.j AS i, b.j AS j, round(covar_samp(a.v, b.v), 8) AS v FROM m a JOIN m b ON a.i = b.i GROUP BY 1, 2""")
def covariance(t):
    return matrix.covariance(t.embeddings, "embedding").withColumn("v", F.round("v", 8))


@query("i08_skyline_gain", f"""
WITH {_GRID}, r AS (SELECT i, max(v) AS r FROM g GROUP BY 1), c AS (SELECT j, max(v) AS c FROM g GROUP BY 1)
SELECT CAST(sum(least(r, c) - v) AS BIGINT) AS gain FROM g JOIN r USING (i) JOIN c USING (j) WHERE v <> r AND v <> c""")
def skyline_gain(t):
    return matrix.skyline_gain(cells(t).groupBy("i", "j").agg(F.count(F.lit(1)).alias("v")))


@query("i09_neighbour_counts", """
WITH k AS (SELECT DISTINCT CAST(p_size AS BIGINT) AS i, CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS j FROM part WHERE p_type = 'PROMO'),
 g AS (SELECT a.i, b.j FROM range(1, 51) a(i), range(1, 26) b(j))
SELECT g.i, g.j, CAST(CASE WHEN bool_or(k.i = g.i AND k.j = g.j) THEN -1 ELSE count(k.i) END AS BIGINT) AS n
FROM g LEFT JOIN k ON k.i BETWEEN g.i - 1 AND g.i + 1 AND k.j BETWEEN g.j - 1 AND g.j + 1 GROUP BY 1, 2""")
def neighbour_counts(t):
    return matrix.neighbour_counts(cells(t).filter("p_type = 'PROMO'"), 50, 25)
