"""The audits count what the cleaning really keeps."""

from strata.operators import clean as C
from strata.plans.queries import QUERIES
from strata.plans.workspace import Workspace

SF = "/root/testdata/sf0.001"


def test_audits_show_rows_that_the_dedupe_loses_or_keeps_twice(spark, monkeypatch):
    right = {k: QUERIES[k](Workspace(spark, SF)).collect() for k in ("dedupe_audit", "pipeline_audit")}
    plain = C.dedupe_latest

    def faulty(df, key, *args, **kwargs):
        out = plain(df, key, *args, **kwargs)
        return out.where("cst_id IS NULL OR cst_id % 2 = 0") if "cst_id" in df.columns else out.unionByName(out)

    monkeypatch.setattr(C, "dedupe_latest", faulty)
    ws = Workspace(spark, SF)
    d, was = QUERIES["dedupe_audit"](ws).first(), right["dedupe_audit"][0]
    assert d["rows_before"] == was["rows_before"] and d["rows_after"] < was["rows_after"] and d["rows_removed"] == d["rows_before"] - d["rows_after"]
    was = {r["entity"]: r for r in right["pipeline_audit"]}
    for r in QUERIES["pipeline_audit"](ws).collect():
        assert (r["rows_in"], r["null_keys_dropped"]) == (was[r["entity"]]["rows_in"], was[r["entity"]]["null_keys_dropped"])
        assert r["rows_out"] < was["customer"]["rows_out"] if r["entity"] == "customer" else r["rows_out"] == 2 * was[r["entity"]]["rows_out"]
        assert r["rows_in"] == r["rows_out"] + r["duplicates_removed"] + r["null_keys_dropped"]
