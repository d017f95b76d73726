import json
import shutil

import pytest

from lodestone.operators.metrics import metric, metric_by, metrics
from lodestone.operators.star import STAR_TABLES
from lodestone.sources import semantic


def test_documents(spark):
    rows = {r.doc_id: r for r in semantic.load_documents(spark).collect()}
    assert len(rows) == 11
    assert sum(k.startswith("table:") for k in rows) == 6 and sum(k.startswith("metric:") for k in rows) == 5
    text = rows["table:dim_region"].text.split("\n")
    assert text[0] == "Table: dim_region" and text[2] == "Grain: one row per nation_key"
    assert text[3] == "Columns:" and text[4].startswith("  - nation_key: ") and text[7] == "Caveats:"
    metric_text = rows["metric:order_count"].text
    assert "Answers questions like: number of orders, how many orders, order volume\n" in metric_text
    assert metric_text.split("SQL:\n")[1].startswith("SELECT COUNT(DISTINCT order_key)")


def test_shipped_documents_are_complete(spark):
    assert semantic.missing_fields(spark).count() == 0


def test_shipped_documents_match_the_tables(spark, warehouse):
    assert semantic.schema_drift(spark, dict(warehouse.items())).collect() == []


def test_drift_shows_both_ways(spark, warehouse):
    tables = dict(warehouse.items())
    tables["dim_region"] = tables["dim_region"].selectExpr(
        "CAST(nation_key AS int) AS nation_key", "nation_name", "1 AS extra")
    drift = {(r.table, r.column): (r.documented, r.actual) for r in semantic.schema_drift(spark, tables).collect()}
    assert drift == {
        ("dim_region", "nation_key"): ("BIGINT", "int"),
        ("dim_region", "region_name"): ("VARCHAR", None),
        ("dim_region", "extra"): (None, "int"),
    }


def test_blank_fields_are_found(spark, tmp_path):
    folder = tmp_path / "layer"
    shutil.copytree(semantic.SHIPPED, folder)
    path = folder / "tables" / "dim_region.json"
    doc = json.loads(path.read_text())
    doc["grain"] = "  "
    del doc["columns"]["nation_name"]["description"]
    path.write_text(json.dumps(doc))
    found = {tuple(r) for r in semantic.missing_fields(spark, str(folder)).collect()}
    assert found == {("dim_region", "grain"), ("dim_region.nation_name", "description")}


def test_yaml_reads_like_json(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    folder = tmp_path / "layer"
    (folder / "tables").mkdir(parents=True)
    source = json.loads(open(f"{semantic.SHIPPED}/tables/dim_region.json").read())
    (folder / "tables" / "dim_region.yml").write_text(yaml.safe_dump(source, sort_keys=False))
    metrics_doc = json.loads(open(f"{semantic.SHIPPED}/metrics.json").read())
    (folder / "metrics.yml").write_text(yaml.safe_dump(metrics_doc, sort_keys=False))
    ours = {tuple(r) for r in semantic.load_documents(spark).collect()}
    theirs = {tuple(r) for r in semantic.load_documents(spark, str(folder)).collect()}
    assert len(theirs) == 6 and theirs <= ours


def test_metric_sql_equals_the_metric(spark, warehouse, data):
    from lodestone.operators.star import Warehouse

    own = spark.newSession()
    Warehouse.derive(own, data).register_views(own)
    documented = {r["name"]: r["sql"] for r in semantic.read_metric_docs(spark).collect()}
    assert set(documented) == set(metrics())
    for name, sql in documented.items():
        assert own.sql(sql).first()[0] == metric(warehouse, name).first()[0] is not None


def test_metrics_of_an_empty_fact_are_null_or_zero(spark, warehouse):
    from lodestone.operators.star import Warehouse

    empty = Warehouse.of({"fact_orders": warehouse.fact.limit(0)})
    values = {name: metric(empty, name).first()[0] for name in metrics()}
    assert values.pop("order_count") == 0 and set(values.values()) == {None}


def test_metric_by_joins_only_what_it_needs(warehouse):
    plan = metric_by(warehouse, "total_revenue", "order_status")._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan
    assert metric_by(warehouse, "order_count", "region_name", "quarter").count() == 20


def test_schema_dump(spark, warehouse):
    lines = {r.table: r.line for r in semantic.schema_dump(spark, dict(warehouse.items())).collect()}
    assert set(lines) == set(STAR_TABLES)
    assert lines["dim_region"] == "dim_region(nation_key BIGINT, nation_name STRING, region_name STRING)"
