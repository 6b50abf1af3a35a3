"""Linear-algebra queries (H1-H7)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels as L
from ..operators import linalg as H
from ..sources import tele, tele_ev
from .catalog import TELE_EV_SQL, TELE_SQL, finish, register

FEATS = ["vibration", "revolutions", "speed", "energy", "humidity"]
RULE4 = ["vibration", "speed", "energy", "revolutions"]


def labelled_tele(spark, sf_dir):
    return L.k_of_n(tele(spark, sf_dir), RULE4)


@register("standardize", f"""
WITH {TELE_SQL},
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATS)} FROM tele)
SELECT row_id, {", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END, 6) AS {c}"
                          for c in FEATS)}
FROM tele CROSS JOIN st""")
def q_standardize(spark, sf_dir):
    """H1: population z-scores of the five tele features."""
    t = tele(spark, sf_dir)
    return finish(H.standardize(t, FEATS).select("row_id", *FEATS))


PCA2 = {"vibration_humidity": ["vibration", "humidity"], "vibration_revolutions": ["vibration", "revolutions"]}


@register("pca_variance", f"""
WITH {TELE_SQL}
SELECT 'vibration_humidity' AS setting, round((1 + abs(corr(vibration, humidity))) / 2, 6) AS pc1_var,
       round((1 - abs(corr(vibration, humidity))) / 2, 6) AS pc2_var, CAST(1.0 AS DOUBLE) AS pc12_var_sum,
       count(*) AS n_samples FROM tele WHERE vibration IS NOT NULL AND humidity IS NOT NULL
UNION ALL
SELECT 'vibration_revolutions', round((1 + abs(corr(vibration, revolutions))) / 2, 6),
       round((1 - abs(corr(vibration, revolutions))) / 2, 6), CAST(1.0 AS DOUBLE), count(*)
FROM tele WHERE vibration IS NOT NULL AND revolutions IS NOT NULL""")
def q_pca_variance(spark, sf_dir):
    """H2 on two-feature settings, where the ratio has the closed form
    (1 + |corr|) / 2 for the oracle."""
    return finish(H.pca_variance(tele(spark, sf_dir), PCA2))


@register("pca_variance_silhouette")
def q_pca_variance_silhouette(spark, sf_dir):
    """H2 + H7 in the reference's layout: with and without humidity, PC1/PC2
    variance and the (squared-Euclidean, all rows) silhouette of the 2-of-4
    label on the PC1-PC2 embedding."""
    t = labelled_tele(spark, sf_dir).cache()
    rows = []
    for name, cols in {"with_humidity": FEATS, "without_humidity": FEATS[:-1]}.items():
        ratios, _ = H.pca(t, cols)
        emb = H.pca_project(t, cols, keep=["label_fault"])
        sil = H.silhouette_sq(emb, ["PC1", "PC2"], "label_fault")
        rows.append((name, float(ratios[0]), float(ratios[1]), float(ratios[:2].sum()), sil,
                     int(t.dropna(subset=cols).count())))
    t.unpersist()
    return finish(spark.createDataFrame(rows, "setting string, pc1_var double, pc2_var double, pc12_var_sum double, "
                                              "silhouette_sq_pc12 double, n_samples bigint"))


@register("pca_scree")
def q_pca_scree(spark, sf_dir):
    """H3."""
    return finish(H.pca_scree(tele(spark, sf_dir), FEATS))


@register("pca_loadings")
def q_pca_loadings(spark, sf_dir):
    """H4: all features and without vibration."""
    t = tele(spark, sf_dir)
    a = H.pca_loadings(t, FEATS).withColumn("setting", F.lit("all"))
    b = H.pca_loadings(t, [c for c in FEATS if c != "vibration"]).withColumn("setting", F.lit("without_vibration"))
    return finish(a.unionByName(b))


@register("pca_project")
def q_pca_project(spark, sf_dir):
    """H5: every row on PC1/PC2 with its label."""
    return finish(H.pca_project(labelled_tele(spark, sf_dir), FEATS, keep=["row_id", "label_fault"]))


@register("class_ellipse", f"""
WITH {TELE_SQL},
q4 AS (SELECT quantile_cont(vibration, 0.95) AS v, quantile_cont(speed, 0.95) AS s,
              quantile_cont(energy, 0.95) AS e, quantile_cont(revolutions, 0.95) AS r FROM tele),
lab AS (SELECT vibration, humidity, CAST((CAST(coalesce(vibration > v, false) AS INTEGER) + CAST(coalesce(speed > s, false) AS INTEGER)
        + CAST(coalesce(energy > e, false) AS INTEGER) + CAST(coalesce(revolutions > r, false) AS INTEGER)) >= 2 AS INTEGER)
        AS label_fault FROM tele CROSS JOIN q4),
st AS (SELECT label_fault, count(*) AS n, avg(vibration) AS mean_x, avg(humidity) AS mean_y,
              var_samp(vibration) AS a, covar_samp(vibration, humidity) AS b, var_samp(humidity) AS c
       FROM lab GROUP BY label_fault)
SELECT label_fault, n, round(mean_x, 6) AS mean_x, round(mean_y, 6) AS mean_y,
       round(2 * 1.96 * sqrt((a + c) / 2.0 + sqrt(pow((a - c) / 2.0, 2) + pow(b, 2))), 6) AS width,
       round(2 * 1.96 * sqrt((a + c) / 2.0 - sqrt(pow((a - c) / 2.0, 2) + pow(b, 2))), 6) AS height,
       round(degrees(0.5 * atan2(2 * b, a - c)), 6) AS angle
FROM st WHERE n >= 3 AND a * c - b * b > 0""")
def q_class_ellipse(spark, sf_dir):
    """H6: 1.96-sd ellipse per class of (vibration, humidity)."""
    return finish(H.class_ellipse(labelled_tele(spark, sf_dir), "vibration", "humidity", "label_fault"))


@register("silhouette_sq", f"""
WITH {TELE_EV_SQL},
d AS (SELECT vibration AS x1, k AS x2, is_error AS y FROM tele_ev WHERE vibration IS NOT NULL AND k IS NOT NULL),
st AS (SELECT y, count(*) AS n, sum(x1 * x1 + x2 * x2) AS q, sum(x1) AS s1, sum(x2) AS s2 FROM d GROUP BY y),
p AS (SELECT a.n AS nc,
         (a.n * (x1 * x1 + x2 * x2) - 2 * (x1 * a.s1 + x2 * a.s2) + a.q) / greatest(a.n - 1, 1) AS da,
         (o.n * (x1 * x1 + x2 * x2) - 2 * (x1 * o.s1 + x2 * o.s2) + o.q) / o.n AS db
      FROM d JOIN st a ON d.y = a.y JOIN st o ON d.y <> o.y)
SELECT round(avg(CASE WHEN nc <= 1 THEN 0.0 ELSE coalesce((db - da) / nullif(greatest(da, db), 0), 0.0) END), 6)
       AS silhouette_sq FROM p""")
def q_silhouette_sq(spark, sf_dir):
    """H7 (squared Euclidean, exact over all rows)."""
    t = tele_ev(spark, sf_dir)
    s = H.silhouette_sq(t, ["vibration", "k"], "is_error")
    return finish(spark.range(1).select(F.lit(s).cast("double").alias("silhouette_sq")))
