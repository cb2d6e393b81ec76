import datetime as dt
import glob

import pytest
from helpers import values
from pyspark.sql import functions as F

from churnkit.operators import merge as M
from churnkit.schemas import ACTIONS, LAYERS, PREDICTIONS, TABLE_COMMENTS
from churnkit.sources import tables as io

SCHEMA = "k int, a string, b int"


def frames(rows):
    return rows([(1, "x", 1), (2, "y", 2)], SCHEMA), rows([(2, "Y", 20), (3, "z", 30)], SCHEMA)


def test_upsert_updates_inserts_and_leaves_the_rest(rows):
    target, source = frames(rows)
    once = M.merge_upsert(target, source, ["k"])
    assert values(once) == [(1, "x", 1), (2, "Y", 20), (3, "z", 30)]
    assert values(M.merge_upsert(once, source, ["k"])) == values(once)


def test_partial_update_still_inserts_whole_rows(rows):
    target, source = frames(rows)
    assert values(M.merge_upsert(target, source, ["k"], ["a"])) == [(1, "x", 1), (2, "Y", 2), (3, "z", 30)]


def test_upsert_can_set_null(rows):
    target = rows([(1, "x", 1)], SCHEMA)
    assert values(M.merge_upsert(target, rows([(1, None, 5)], SCHEMA), ["k"])) == [(1, None, 5)]


def test_insert_only_looks_at_the_filtered_target(rows):
    target = rows([(1, "open", 1), (2, "done", 2)], SCHEMA)
    source = rows([(1, "open", 9), (2, "open", 9)], SCHEMA)
    got = M.merge_insert(target, source, ["k"], F.col("a") == "open")
    assert values(got) == [(1, "open", 1), (2, "done", 2), (2, "open", 9)]


def test_update_and_delete_ignore_null_conditions(rows):
    df = rows([(1, "x", None), (2, "y", 5)], SCHEMA)
    assert values(M.update_where(df, F.col("b") > 1, {"a": F.lit("new")})) == [(1, "x", None), (2, "new", 5)]
    assert values(M.delete_where(df, F.col("b") > 1)) == [(1, "x", None)]
    assert values(M.delete_keys(df, rows([(1,)], "k int"), "k")) == [(2, "y", 5)]


def test_update_sees_the_old_values(rows):
    df = rows([(1, "x", 1)], SCHEMA)
    got = M.update_where(df, F.col("a") == "x", {"a": F.lit("y"), "b": F.when(F.col("a") == "x", 7)})
    assert values(got) == [(1, "y", 7)]


def test_update_keys(rows):
    df = rows([(1, "x", 1), (2, "y", 2)], SCHEMA)
    assert values(M.update_keys(df, rows([(2,), (2,)], "k int"), "k", {"b": F.lit(0)})) == [(1, "x", 1), (2, "y", 0)]


def test_table_round_trip_and_rewrite(spark, rows, tmp_path):
    target, source = frames(rows)
    stored = io.write_table(target, str(tmp_path), "gold", "t")
    merged = M.merge_upsert(stored, source, ["k"])
    again = io.rewrite_table(merged, str(tmp_path), "gold", "t")
    assert values(again) == [(1, "x", 1), (2, "Y", 20), (3, "z", 30)]
    assert values(io.read_table(spark, str(tmp_path), "gold", "t")) == values(again)


def test_partition_overwrite_leaves_other_days(spark, rows, tmp_path):
    schema = "company_id int, day date, p double"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    io.write_table(rows([(1, d1, 0.1), (1, d2, 0.2)], schema), str(tmp_path), "gold", "p", ["day"])
    stored = io.read_table(spark, str(tmp_path), "gold", "p").select("company_id", "day", "p")
    new = rows([(1, d2, 0.9), (2, d2, 0.8)], schema)
    touched = stored.join(new.select("day").distinct(), "day", "left_semi").select("company_id", "day", "p")
    io.overwrite_partitions(M.merge_upsert(touched, new, ["company_id", "day"]), str(tmp_path), "gold", "p", ["day"])
    got = io.read_table(spark, str(tmp_path), "gold", "p").select("company_id", "day", "p")
    assert values(got) == [(1, d1, 0.1), (1, d2, 0.9), (2, d2, 0.8)]


def test_empty_tables_keep_their_schema(spark, tmp_path):
    for name, schema in (("actions", ACTIONS), ("predictions", PREDICTIONS)):
        stored = io.write_table(io.create_empty(spark, schema), str(tmp_path), "gold", name)
        assert stored.count() == 0
        assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]


def test_layers_and_comments(spark, rows):
    names = io.ensure_layers(spark, "ck_")
    assert names == ["ck_bronze", "ck_silver", "ck_gold", "ck_ml"]
    io.ensure_layers(spark, "ck_")
    io.save_catalog_table(rows([(1, 2)], "company_id int, health_score int"), "ck_gold.health")
    io.apply_comments(spark, "ck_gold.health", TABLE_COMMENTS["agg_company_health_score"], {"health_score": "it's 0 to 100"})
    described = {r.col_name: r.comment for r in spark.sql("DESCRIBE ck_gold.health").collect()}
    assert described["health_score"] == "it's 0 to 100"
    extended = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED ck_gold.health").collect()}
    assert extended["Comment"].startswith("Weighted health score")
    for n in names:
        spark.sql(f"DROP DATABASE {n} CASCADE")


def test_stamp_and_drop_meta(rows):
    df = io.stamp(rows([(1, "p")], "k int, churn_profile string"), "crm")
    assert df.columns == ["k", "churn_profile", "_ingested_at", "_source"]
    assert df.first()["_source"] == "crm"
    assert io.drop_meta(df).columns == ["k"]


def test_csv_export_has_a_header(rows, tmp_path):
    io.export_csv(rows([(1, "x")], "k int, a string"), str(tmp_path / "out"))
    text = "".join(open(f).read() for f in glob.glob(str(tmp_path / "out" / "*.csv")))
    assert text.splitlines()[0] == "k,a" and "1,x" in text


def test_inline_rows(spark):
    assert values(io.inline_rows(spark, [(1, "a")], "k int, v string")) == [(1, "a")]


def test_a_source_key_that_comes_twice_raises(rows):
    from churnkit.operators.merge import merge_upsert

    target = rows([(1, "a"), (2, "b")], "k int, v string")
    source = rows([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        merge_upsert(target, source, ["k"]).collect()


def test_missing_tables_are_made_and_filled_ones_kept(spark, rows, tmp_path):
    from churnkit.sources import tables as io

    schema = rows([], "k int, v string").schema
    assert io.ensure_table(spark, schema, str(tmp_path), "gold", "t").count() == 0
    io.write_table(rows([(1, "a")], "k int, v string"), str(tmp_path), "gold", "t")
    assert io.ensure_table(spark, schema, str(tmp_path), "gold", "t").count() == 1


def test_a_write_killed_midway_leaves_the_old_table(spark, rows, tmp_path, monkeypatch):
    place = (str(tmp_path), "gold", "t")
    io.write_table(rows([(1, "old")], "k int, v string"), *place)

    class Killed(Exception):
        pass

    def killed(*_):
        raise Killed

    # After the rows are written and before the commit; then while the rows are being written.
    with monkeypatch.context() as m:
        m.setattr(io, "_commit", killed)
        with pytest.raises(Killed):
            io.write_table(rows([(2, "new")], "k int, v string"), *place)
    broken = rows([(1, "x")], "k int, v string").withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        io.write_table(broken, *place)
    assert values(io.read_table(spark, *place)) == [(1, "old")]
    io.write_table(rows([(3, "next")], "k int, v string"), *place)
    assert values(io.read_table(spark, *place)) == [(3, "next")]


def test_a_partition_overwrite_killed_midway_leaves_all_days(spark, rows, tmp_path, monkeypatch):
    place, schema = (str(tmp_path), "gold", "p"), "k int, day date"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    io.write_table(rows([(1, d1), (2, d2)], schema), *place, ["day"])
    with monkeypatch.context() as m:
        m.setattr(io, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            io.overwrite_partitions(rows([(9, d2)], schema), *place, ["day"])
    assert values(io.read_table(spark, *place).select("k", "day")) == [(1, d1), (2, d2)]


def test_readers_keep_the_version_they_planned_on_and_old_ones_go(spark, rows, tmp_path):
    place = (str(tmp_path), "gold", "t")
    planned = io.write_table(rows([(0,)], "k int"), *place)
    for k in (1, 2):
        io.write_table(rows([(k,)], "k int"), *place)
    assert values(planned) == [(0,)]
    for k in (3, 4, 5):
        io.write_table(rows([(k,)], "k int"), *place)
    assert len(glob.glob(str(tmp_path / "gold" / "t" / "_v=*"))) == io.KEPT_COMMITS
    assert values(io.read_table(spark, *place)) == [(5,)]


def test_null_days_and_one_column_of_partitions(spark, rows, tmp_path):
    place, schema = (str(tmp_path), "gold", "p"), "k int, day date"
    io.write_table(rows([(1, None), (2, dt.date(2024, 1, 2))], schema), *place, ["day"])
    io.overwrite_partitions(rows([(3, None)], schema), *place, ["day"])
    assert values(io.read_table(spark, *place).select("k")) == [(2,), (3,)]
    with pytest.raises(ValueError):
        io.write_table(rows([(1, 2)], "a int, b int"), *place, ["a", "b"])
    with pytest.raises(ValueError):
        io.overwrite_partitions(rows([(1, 2)], "a int, b int"), *place, ["a"])


def test_a_folder_written_by_others_is_read_as_it_is(spark, rows, tmp_path):
    rows([(1, "a")], "k int, v string").write.parquet(str(tmp_path / "bronze" / "raw"))
    assert values(io.read_table(spark, str(tmp_path), "bronze", "raw")) == [(1, "a")]


def test_published_tables_follow_the_newest_commit(spark, rows, tmp_path):
    schema = rows([], "k int, day date").schema
    place = (str(tmp_path), "gold", "p")
    io.ensure_layers(spark, "cx_")
    io.ensure_table(spark, schema, *place, ["day"])
    io.publish_table(spark, *place, schema, "cx_", "it's \"new\"", {"k": "key's comment"})
    assert spark.table("cx_gold.p").count() == 0
    for k, day in ((1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, dt.date(2024, 1, 2))):
        io.overwrite_partitions(rows([(k, day)], "k int, day date"), *place, ["day"])
    io.publish_table(spark, *place, schema, "cx_", "about", {"k": "key's comment"})
    assert values(spark.table("cx_gold.p").select("k")) == [(1,), (3,)]
    assert spark.catalog.getTable("cx_gold.p").description == "about"
    assert {c.name: c.description for c in spark.catalog.listColumns("cx_gold.p")} == {"k": "key's comment", "day": None}
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE cx_{layer} CASCADE")
