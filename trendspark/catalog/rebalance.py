"""Class rebalancing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import query, rounded, table
from trendspark.operators import resample
from trendspark.session import c

# Labelled documents: two uneven classes.
_CLASSES_SQL = """
y AS (SELECT doc_id, toxic FROM labels),
n AS (SELECT toxic, count(*) AS n FROM y GROUP BY 1),
lo AS (SELECT toxic, n FROM n ORDER BY n, toxic LIMIT 1), hi AS (SELECT toxic, n FROM n ORDER BY n DESC, toxic DESC LIMIT 1),
h AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(doc_id::varchar || '42'), doc_id) AS r FROM y)"""


@query(
    f"""WITH {_CLASSES_SQL}
SELECT doc_id, h.toxic, cast(CASE WHEN h.toxic = lo.toxic THEN hi.n // lo.n + CASE WHEN r <= hi.n % lo.n THEN 1 ELSE 0 END ELSE 1 END AS bigint) AS copies FROM h, lo, hi"""
)
def over_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minority rows repeated to the majority's size, as copies per row."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    grown = resample.over_sample(labels, "toxic", "doc_id")
    return grown.groupBy("doc_id", "toxic").agg(F.count(F.lit(1)).alias("copies"))


@query(f"WITH {_CLASSES_SQL} SELECT doc_id, h.toxic FROM h, lo, hi WHERE h.toxic <> hi.toxic OR r <= lo.n")
def under_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.under_sample(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic", "doc_id")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.when(c("label") < 3, 1).otherwise(0)
    return table(spark, sf_dir, "embeddings").select("vec_id", target.alias("target"), c("embedding").cast("array<double>").alias("embedding"))


_VECTORS_SQL = "v AS (SELECT vec_id, CASE WHEN label < 3 THEN 1 ELSE 0 END AS target, embedding::double[] AS e FROM embeddings)"


def _unit(key: str, seed: int) -> str:
    return f"('0x' || substr(md5({key} || '{seed}'), 1, 8))::bigint / 4294967296.0::double"


_GROWN_SQL = f"""{_VECTORS_SQL}, m AS (SELECT vec_id::varchar AS id, e FROM v WHERE target = 1),
close AS (SELECT qid, bid, rk FROM (SELECT a.id AS qid, b.id AS bid, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.e, b.e), b.id) AS rk
  FROM m a, m b WHERE a.id <> b.id) WHERE rk <= 5),
s AS (SELECT count(*) FILTER (target = 1) AS lo, count(*) FILTER (target = 0) - count(*) FILTER (target = 1) AS missing FROM v),
r AS (SELECT id, e, row_number() OVER (ORDER BY md5(id || '42'), id) AS r FROM m),
seeds AS (SELECT id, e, unnest(range(1, cast(missing // lo + 1 AS bigint))) AS copy FROM r, s
  UNION ALL SELECT id, e, cast(missing // lo + 1 AS bigint) FROM r, s WHERE r <= missing % lo),
drawn AS (SELECT id, e, copy, cast(floor({_unit("id || '|' || copy", 42)} * 5) AS int) + 1 AS pick, {_unit("id || '|' || copy", 43)} AS gap FROM seeds),
made AS (SELECT 'smote-' || d.id || '-' || d.copy AS vec_id, 1 AS target, list_transform(range(1, 65), lambda i: d.e[i] + (m.e[i] - d.e[i]) * d.gap) AS e
  FROM drawn d JOIN close ON d.id = close.qid AND d.pick = close.rk JOIN m ON m.id = close.bid),
grown AS (SELECT vec_id::varchar AS vec_id, target, e FROM v UNION ALL SELECT * FROM made)"""


@query(f"WITH {_GROWN_SQL} SELECT vec_id, target, round(e[1], 4) + 0.0 AS first, round(list_sum(e), 4) + 0.0 AS total FROM grown")
def smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic minority vectors, reproduced from the same hashes."""
    grown = resample.smote(_vectors(spark, sf_dir), "embedding", "target", "vec_id")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return rounded(grown.select("vec_id", "target", c("embedding")[0].alias("first"), total.alias("total")), "first", "total")


_LINKS_SQL = f"""{_VECTORS_SQL},
near AS (SELECT qid, bid FROM (SELECT a.vec_id AS qid, b.vec_id AS bid, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS rk
  FROM v a, v b WHERE a.vec_id <> b.vec_id) WHERE rk = 1),
links AS (SELECT f.qid AS a, f.bid AS b, va.target AS target_a, vb.target AS target_b FROM near f JOIN near g ON f.qid = g.bid AND f.bid = g.qid
  JOIN v va ON va.vec_id = f.qid JOIN v vb ON vb.vec_id = f.bid WHERE f.qid < f.bid AND va.target <> vb.target)"""


@query(f"WITH {_LINKS_SQL} SELECT a, b, target_a, target_b FROM links")
def tomek_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mutual nearest vectors of different classes."""
    return resample.tomek_pairs(_vectors(spark, sf_dir), "embedding", "target", "vec_id")


@query(
    f"""WITH {_LINKS_SQL}
SELECT vec_id, target FROM v WHERE vec_id NOT IN (SELECT a FROM links WHERE target_a = 0 UNION ALL SELECT b FROM links WHERE target_b = 0)"""
)
def tomek_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors left after the majority member of every link is removed."""
    return resample.tomek_links(_vectors(spark, sf_dir), "embedding", "target", "vec_id").select("vec_id", "target")


@query(
    f"""WITH {_GROWN_SQL},
near AS (SELECT qid, bid FROM (SELECT a.vec_id AS qid, b.vec_id AS bid, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS rk
  FROM grown a, grown b WHERE a.vec_id <> b.vec_id) WHERE rk = 1),
links AS (SELECT f.qid AS a, f.bid AS b FROM near f JOIN near g ON f.qid = g.bid AND f.bid = g.qid
  JOIN grown x ON x.vec_id = f.qid JOIN grown y ON y.vec_id = f.bid WHERE x.target <> y.target)
SELECT vec_id, target FROM grown WHERE vec_id NOT IN (SELECT a FROM links UNION ALL SELECT b FROM links)"""
)
def smote_tomek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic rows added, then both members of every link removed."""
    kept = resample.smote_tomek(_vectors(spark, sf_dir), "embedding", "target", "vec_id")
    return kept.select("vec_id", "target")


@query(
    """SELECT doc_id, round((SELECT count(*) FROM labels) / ((SELECT count(DISTINCT toxic) FROM labels) * count(*) OVER (PARTITION BY toxic))::double, 4) AS weight FROM labels"""
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = resample.class_weights(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic")
    return rounded(labels.select("doc_id", "weight"), "weight")


@query(
    f"""WITH {_LINKS_SQL}, c AS (SELECT count(*) FILTER (target = 1) AS lo, count(*) FILTER (target = 0) AS hi FROM v)
SELECT 'balanced' AS mode, 0 AS target, hi AS n FROM c UNION ALL SELECT 'balanced', 1, lo FROM c
UNION ALL SELECT m, t, hi FROM c, (VALUES ('over'), ('smote')) x(m), (VALUES (0), (1)) y(t)
UNION ALL SELECT 'under', t, lo FROM c, (VALUES (0), (1)) y(t)
UNION ALL SELECT 'tomek', 0, hi - (SELECT count(*) FROM links) FROM c UNION ALL SELECT 'tomek', 1, lo FROM c"""
)
def resample_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class sizes after each mode; an unknown mode changes nothing."""
    vectors = _vectors(spark, sf_dir)
    parts = []
    for mode in ("over", "under", "smote", "tomek", "balanced"):
        rows = resample.resample(vectors, mode, "embedding", "target", "vec_id")
        sizes = rows.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
        parts.append(sizes.select(F.lit(mode).alias("mode"), "target", "n"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
