"""Intermediate tables: one folder per application, removed when they are replaced or cleared."""
import os

from faultline.llm import common
from faultline.llm.components import connected_components
from faultline.session import checkpoint_dir


def _path(spark):
    return common.run_folder(spark).removeprefix("file://").removeprefix("file:")


def test_replaced_tables_go_and_clear_leaves_nothing(spark):
    a = common.stored(spark.range(5), "a")
    b = common.stored(a.selectExpr("id + 1 as id"), "b", [a])
    names = os.listdir(_path(spark))
    assert b.count() == 5 and not any(n.startswith("a-") for n in names) and any(n.startswith("b-") for n in names)
    n = len(os.listdir(_path(spark)))
    got = connected_components(spark.range(200).selectExpr("id as u", "id + 1 as v"))
    assert got.where("component = 0").count() == 201
    assert len(os.listdir(_path(spark))) == n + 1       # the last table alone, however many rounds there were
    common.clear(spark)
    assert not os.path.exists(_path(spark)) and checkpoint_dir(spark)
