"""The whole workflow on a small claims table, and scoring new claims with what it kept."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens import schema
from claimlens.models.scoring import score_claims
from claimlens.models.training import load_model
from claimlens.plans.workflow import NETWORKS, build_silver, fit_severity_models
from claimlens.sources import catalog
from claimlens.sources.claims import VIEW_KEY


def test_workflow(spark, lab, tmp_path):
    catalog.create_database(spark, "flow_db", str(tmp_path / "db"))
    silver = build_silver(
        lab.bronze, VIEW_KEY, after_year=1995, table="flow_db.silver", path=str(tmp_path / "silver")
    )
    same = lab.silver.select(silver.columns)
    assert silver.exceptAll(same).count() == 0 == same.exceptAll(silver).count()
    out = fit_severity_models(silver, str(tmp_path / "runs"), features_from="learn", epochs=2)
    rows = out.comparison.collect()
    assert {r["run_id"] for r in rows} == set(out.runs.values()) and set(out.runs) == {"null_model", *NETWORKS}
    assert out.history.count() == 12
    params = out.log.runs().filter("kind = 'param'")
    assert params.count() == 24
    assert params.filter("key = 'rows_left_out'").agg(F.max("value")).first()[0] == 0
    assert params.filter("key = 'epochs'").agg(F.max("value")).first()[0] == 2
    # every run keeps its own weights and can score claims that were never numbered
    kept = [load_model(out.log.weights(out.runs[name])) for name in NETWORKS]
    assert [m.spec.power for m in kept] == [p for _, _, p in NETWORKS.values()]
    assert [len(m.history) for m in out.models] == [2] * 6
    history = out.log.history(out.runs["ffn_p3"]).orderBy("epoch").collect()
    assert [tuple(r) for r in history] == out.models[2].history
    # one calibration table for all models: every level once, its observed mean beside all fits
    table = out.calibration.collect()
    test = out.scored.filter("split = 'test'")
    levels = sum(test.select(c).distinct().count() for c in schema.CALIBRATION_FEATURES)
    assert len(table) == levels and all(r[f"pred_{m}"] > 0 for r in table for m in out.runs)
    men = test.filter("Gender = 'F'").agg(F.avg("Claim"), F.avg("localglm_p2")).first()
    (row,) = [r for r in table if (r["feature"], r["level"]) == ("Gender", "F")]
    assert abs(row["obs"] / men[0] - 1) < 1e-9 and abs(row["pred_localglm_p2"] / men[1] - 1) < 1e-9
    kept_table = out.log.calibration(out.runs["localglm_p2"]).filter("feature = 'Gender' AND level = 'F'")
    assert abs(kept_table.first()["pred"] / men[1] - 1) < 1e-9
    # a second run in the same folder stays apart
    again = fit_severity_models(silver, str(tmp_path / "runs"), features_from="learn", epochs=1)
    assert again.comparison.count() == 14 and not set(again.runs.values()) & set(out.runs.values())
    assert load_model(again.log.weights(again.runs["ffn_p2"])).spec == kept[0].spec
    fresh = lab.bronze.limit(200)
    scored = score_claims(fresh, out.log.features(out.runs["ffn_p2"]), kept)
    assert scored.columns == [*fresh.columns, *NETWORKS]
    assert scored.filter(F.col("localglm_p3") <= 0).count() == 0 and scored.count() == 200
    rescored = score_claims(silver.drop("Id"), out.log.features(out.runs["ffn_p2"]), kept)
    means = [df.agg(*[F.avg(n) for n in NETWORKS]).first() for df in (rescored, out.scored)]
    assert all(abs(a / b - 1) < 1e-9 for a, b in zip(*means))
    assert set(schema.METRICS) <= set(out.comparison.columns)
    catalog.drop_database(spark, "flow_db", confirm=True)
