from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimlens.schema import CLAIMS_SCHEMA
from claimlens.sources import catalog
from claimlens.sources.claims import claims_view, ingest, ingest_checked
from claimlens.sources.storage import shared_dir, stage


def test_database_and_tables(spark, tmp_path, lab):
    catalog.create_database(spark, "lab_db", str(tmp_path / "db"))
    catalog.create_database(spark, "lab_db")
    df = lab.silver.select("Id", "Claim").limit(10)
    path = str(tmp_path / "claims")
    table = catalog.publish(df, "lab_db.claims", path, comment="It's a claim table")
    assert table.count() == 10 == catalog.scan_path(spark, path).count()
    catalog.publish(df.limit(3), "lab_db.claims", path)
    assert catalog.scan_table(spark, "lab_db.claims").count() == 3
    detail = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED lab_db.claims").collect()}
    assert detail["Type"] == "EXTERNAL"
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, "lab_db")
    try:
        assert spark.catalog.tableExists("claims")
    finally:
        catalog.use_database(spark, before)
    catalog.drop_table(spark, "lab_db.claims")
    assert not spark.catalog.tableExists("lab_db.claims")
    assert catalog.scan_path(spark, path).count() == 3
    with pytest.raises(ValueError):
        catalog.drop_database(spark, "lab_db")
    catalog.drop_database(spark, "lab_db", confirm=True)
    assert not spark.catalog.databaseExists("lab_db")


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    catalog.write_table(spark.range(3), path, mode="errorifexists")
    with pytest.raises(Exception):
        catalog.write_table(spark.range(3), path, mode="errorifexists")
    catalog.write_table(spark.range(4), path, mode="append")
    assert catalog.scan_path(spark, path).count() == 7


def test_ingest_uses_the_declared_schema(spark, tmp_path, lab):
    columns = [f.name for f in CLAIMS_SCHEMA]
    path = str(tmp_path / "raw")
    lab.bronze.select(columns).limit(50).write.option("header", True).csv(path)
    df = ingest(spark, path, fmt="csv", header="true")
    assert df.schema == CLAIMS_SCHEMA and df.count() == 50
    assert df.filter(F.col("Claim").isNull()).count() == 0


def test_view_keeps_rows_and_the_date_bound_changes_nothing(spark, small_dir):
    view = claims_view(spark, small_dir)
    assert view.count() == 3185
    bounded = claims_view(spark, small_dir, first_year=1996)
    assert bounded.count() == view.filter("AccYear >= 1996").count()


def test_schema_report_and_preview(lab):
    rows = catalog.schema_report(lab.silver, F.col("Id") == 1).orderBy("position").collect()
    assert [r["name"] for r in rows] == lab.silver.columns
    assert {r["non_null"] for r in rows} == {lab.silver.count()}
    top = catalog.preview(lab.silver, ["Id"])
    assert [r["Id"] for r in top.collect()] == [1, 2, 3, 4, 5, 6]


def test_stage_freezes_values(spark):
    frozen = stage(spark.range(100).select(F.rand().alias("r")), "frozen")
    assert frozen.agg(F.sum("r")).first()[0] == frozen.agg(F.sum("r")).first()[0]
    assert shared_dir(spark) in frozen.inputFiles()[0]


def test_a_reader_sees_whole_versions(spark, tmp_path, lab):
    name, folder = "default.versions", str(tmp_path / "versions")
    first = catalog.publish_version(spark.range(5), name, folder, comment="It's the first")
    second = catalog.publish_version(spark.range(7), name, folder)
    assert first.count() == 5 and second.count() == 7 == spark.table(name).count()
    # The new rows may come from the table that they replace.
    third = catalog.publish_version(spark.table(name).filter("id > 1"), name, folder)
    assert third.count() == 5 and second.count() == 7

    def broken(batches):
        raise RuntimeError("lost")
        yield

    with pytest.raises(Exception, match="lost"):
        catalog.publish_version(spark.range(9).mapInArrow(broken, "id bigint"), name, folder)
    assert spark.table(name).count() == 5
    with pytest.raises(ValueError, match="other columns"):
        catalog.publish_version(spark.range(2).withColumnRenamed("id", "n"), name, folder)
    assert catalog.remove_old_versions(spark, name, folder) == []
    gone = catalog.remove_old_versions(spark, name, folder, older_than=0)
    assert len(gone) == 3 and spark.table(name).count() == 5
    assert catalog.location(spark, name).rpartition("/")[2] not in gone
    other = catalog.publish_version(spark.range(2).withColumnRenamed("id", "n"), name, folder, new_schema=True)
    assert other.columns == ["n"] and spark.table(name).count() == 2
    catalog.drop_table(spark, name)


def test_bad_records_are_kept_apart(spark, tmp_path):
    from pyspark.sql import types as T

    shape = T.StructType.fromDDL("Claim double, Age int, Gender string")
    (tmp_path / "a.csv").write_text('1.5,30,"F"\nx,30,M\n2.5,31\n,32,F\n3.5,33,F,more\n4.5,,\n\n"open,1,F\n')
    good, bad = ingest_checked(spark, str(tmp_path / "a.csv"), shape, required=["Claim", "Age"])
    assert good.schema == shape and [tuple(r) for r in good.collect()] == [(1.5, 30, "F")]
    found = sorted((r["reason"], r["record"]) for r in bad.collect())
    assert [f for f in found if f[0] == "malformed"] == [
        ("malformed", '"open,1,F'),
        ("malformed", "2.5,31"),
        ("malformed", "3.5,33,F,more"),
        ("malformed", "x,30,M"),
    ]
    assert [f for f in found if f[0] != "malformed"] == [
        ("missing Age", '{"Claim":4.5}'),
        ("missing Claim", '{"Age":32,"Gender":"F"}'),
    ]
    (tmp_path / "b.json").write_text('{"Claim": 1.0, "Age": 3}\n{"Claim": "no"}\n{broken\n')
    good, bad = ingest_checked(spark, str(tmp_path / "b.json"), shape, fmt="json")
    assert good.count() == 1 and [r["reason"] for r in bad.collect()] == ["malformed"] * 2
    assert all(r["file"].endswith("b.json") for r in bad.collect())
    spark.createDataFrame([(None, 1, "F"), (2.0, 1, "F")], shape).write.parquet(str(tmp_path / "c"))
    good, bad = ingest_checked(spark, str(tmp_path / "c"), shape, fmt="parquet")
    assert good.count() == 1 and [r["reason"] for r in bad.collect()] == ["missing Claim"]
