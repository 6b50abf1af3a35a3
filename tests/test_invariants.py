"""Invariants of the rows-only operators on the sf0.001 tables."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from faultline.operators import labels as L
from faultline.operators import linalg as H
from faultline.operators import metrics as J
from faultline.operators import models as M
from faultline.operators import splits as G
from faultline.sources import tele

FEATS = ["vibration", "revolutions", "speed", "energy", "humidity"]
RULE4 = ["vibration", "speed", "energy", "revolutions"]


@pytest.fixture(scope="module")
def prepared(spark):
    t = L.k_of_n(tele(spark, SF), RULE4, q=0.8).select("row_id", *FEATS, "label_fault")
    t = M.class_weights(t, "label_fault")
    return G.split_stratified(t, "label_fault").cache()


def test_loadings_orthonormal_and_sign_fixed(spark):
    ratios, vecs = H.pca(tele(spark, SF), FEATS, k=2)
    assert np.allclose(vecs.T @ vecs, np.eye(2), atol=1e-9)
    for j in range(2):
        assert vecs[np.argmax(np.abs(vecs[:, j])), j] > 0
    assert ratios[0] >= ratios[1] and abs(ratios.sum() - 1) < 1e-9


def test_importances_probabilities_pdp(spark, prepared):
    tr = prepared.where("fold = 'train'")
    te = prepared.where("fold = 'test'")
    m = M.fit(tr, FEATS, "label_fault", "rf", {"maxDepth": 6}, num_trees=10)
    imp = M.impurity_importance(m, FEATS)
    assert abs(sum(v for _, v in imp) - 1.0) < 1e-9
    s = M.score_rows(m, te, keep=["label_fault"])
    assert s.where((F.col("p_fault") < 0) | (F.col("p_fault") > 1)).count() == 0
    pdp = M.partial_dependence(m, te, "vibration", n_grid=5).collect()
    assert len(pdp) == 5 and all(0.0 <= r["mean_p_fault"] <= 1.0 for r in pdp)
    rules = M.tree_rules(M.fit(tr, FEATS, "label_fault", "tree", {"maxDepth": 2}), FEATS)
    assert 1 <= len(rules) <= 4 and all(p in (0, 1) for _, p in rules)


def test_folds_disjoint_and_complete(prepared):
    n = prepared.count()
    assert prepared.select("row_id").distinct().count() == n
    assert prepared.where(F.col("fold").isNull()).count() == 0


def test_classification_report_literal(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 0), (0, 1)]
    df = spark.createDataFrame(rows, "y int, yhat int")
    rep = {r["metric"]: r for r in J.classification_report(df).collect()}
    assert rep["precision"]["Fault"] == pytest.approx(0.5)
    assert rep["recall"]["Normal"] == pytest.approx(2 / 3)
    assert rep["support"]["Normal"] == 3 and rep["support"]["Fault"] == 2
    assert rep["f1-score"]["accuracy"] == pytest.approx(0.6)
    m = J.binary_metrics(df).first()
    f_normal = 2 * (2 / 3) * (2 / 3) / (4 / 3)          # precision 2/3, recall 2/3
    f_fault = 2 * 0.5 * 0.5 / 1.0                        # precision 1/2, recall 1/2
    assert m["f1_macro"] == pytest.approx((f_normal + f_fault) / 2)
    assert m["recall_fault"] == pytest.approx(0.5)
