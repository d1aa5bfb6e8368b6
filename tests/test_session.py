from conftest import plan_text
from strata.session import ensure_checkpoint_dir, scratch_path


def test_scratch_paths_live_under_the_sessions_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == (spark.conf.get("spark.checkpoint.dir", None) or base)
    a, b = scratch_path(spark, "landing", "x"), scratch_path(spark, "landing", "x")
    assert a.startswith(base.rstrip("/") + "/strata/landing/x/") and a != b


def test_reliable_checkpoint_cuts_lineage(spark):
    from strata.session import cut_lineage

    df = spark.range(100).selectExpr("id % 7 AS k").groupBy("k").count()
    cut = cut_lineage(df)
    assert sorted(tuple(r) for r in cut.collect()) == sorted(tuple(r) for r in df.collect())
    assert "Exchange" not in plan_text(cut).split("\n\n")[0]
