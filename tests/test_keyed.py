from __future__ import annotations

from pyspark.sql import functions as F

from tollbook.operators import keyed
from conftest import plan_of
from tollbook.operators.totals import order_totals
from tollbook.plans.colocated import drop_lead_tables, settle_colocated, write_lead_tables
from tollbook.plans.payments import settle_callbacks
from tollbook.sources import site
from tollbook.sources.tables import append_batch, read_batches, read_version, write_bucketed, write_version


def _set(df):
    return sorted(map(tuple, df.collect()), key=str)


def _base(spark):
    return spark.createDataFrame([(1, "a", 1), (2, "b", 0), (5, "c", 1)], "id long, name string, is_active int")


def test_upsert_twice_is_once(spark):
    changes = spark.createDataFrame([(2, "B", 1), (9, "n", 1)], "id long, name string, is_active int")
    once = keyed.upsert(_base(spark), changes, ["id"])
    assert _set(once) == [(1, "a", 1), (2, "B", 1), (5, "c", 1), (9, "n", 1)]
    assert _set(keyed.upsert(once, changes, ["id"])) == _set(once)


def test_new_ids_go_on_from_the_largest(spark):
    changes = spark.createDataFrame([(10, 0, "x", 1), (11, 2, "y", 0), (12, 0, "z", 1), (13, 2, "w", 1)],
                                    "seq long, id long, name string, is_active int")
    after = keyed.upsert_with_ids(_base(spark), changes, "id", "seq")
    assert _set(after) == [(1, "a", 1), (2, "w", 1), (5, "c", 1), (6, "x", 1), (7, "z", 1)]
    empty = keyed.upsert_with_ids(_base(spark).limit(0), changes, "id", "seq")
    assert _set(empty) == [(1, "x", 1), (2, "w", 1), (2, "z", 1)]


def test_numbering_across_blocks(spark):
    rows = spark.range(1000).select((F.col("id") * 7).alias("seq"))
    numbered = keyed.number_rows(rows, "seq", "n", F.lit(100), block=64)
    assert _set(numbered.select("seq", "n")) == sorted(((i * 7, 101 + i) for i in range(1000)), key=str)


def test_delete_and_set_columns(spark):
    gone = spark.createDataFrame([(2,), (77,)], "id long")
    assert _set(keyed.delete_keys(_base(spark), gone)) == [(1, "a", 1), (5, "c", 1)]
    toggled = keyed.set_columns(_base(spark), spark.createDataFrame([(2, 1), (5, None)], "id long, is_active int"), "id")
    assert _set(toggled) == [(1, "a", 1), (2, "b", 1), (5, "c", 1)]


def test_meta_round(spark):
    meta = spark.createDataFrame([(1, "x", "1"), (1, "y", "2"), (2, "x", "3")], "lead_id long, meta_key string, meta_value string")
    changes = spark.createDataFrame([(1, "x", "9"), (3, "y", "4")], meta.schema)
    after = keyed.upsert_meta(meta, changes)
    assert _set(after) == [(1, "x", "9"), (1, "y", "2"), (2, "x", "3"), (3, "y", "4")]
    assert _set(keyed.delete_meta(after, changes)) == [(1, "y", "2"), (2, "x", "3")]
    assert _set(keyed.pivot_meta(after, ["x", "y"])) == [(1, "9", "2"), (2, "3", None), (3, None, "4")]


def test_versions_and_batches(spark, tmp_path):
    path = str(tmp_path / "table")
    write_version(_base(spark), path, 1)
    write_version(_base(spark).where("id > 1"), path, 2)
    write_version(_base(spark).where("id > 1"), path, 2)
    assert read_version(spark, path).count() == 2 and read_version(spark, path, 1).count() == 3
    write_version(_base(spark).limit(0), path, 3)
    assert read_version(spark, path).count() == 0 and read_version(spark, path).columns == ["id", "name", "is_active"]
    notes, log = spark.createDataFrame([(1, "n")], "lead_id long, text string"), str(tmp_path / "notes")
    for batch in (0, 1, 1):
        append_batch(notes, log, batch)
    assert _set(read_batches(spark, log, "lead_id long, text string")) == [(1, "n", 0), (1, "n", 1)]


def test_bucketed_tables_meet_without_a_shuffle(spark, folder, tmp_path):
    entries = site.entries(spark, folder).drop("answers", "hidden")
    lines = order_totals(site.order_lines(spark, folder)).withColumnRenamed("lead_id", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, df in {"bucketed_entries": entries, "bucketed_totals": lines}.items():
            write_bucketed(df, name, str(tmp_path / name), "id", 8)
        joined = spark.table("bucketed_entries").join(spark.table("bucketed_totals"), "id", "left")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == entries.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_entries", "bucketed_totals"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_numbering_of_far_apart_values_uses_no_single_task(spark):
    """A third of the values lie close together, the others 10 ** 12 apart."""
    values = [i for i in range(300)] + [10**12 * i for i in range(1, 601)]
    rows = spark.createDataFrame([(v, 0, f"n{v}", 1) for v in reversed(values)],
                                 "seq long, id long, name string, is_active int").repartition(5)
    numbered = keyed.number_rows(rows, "seq", "n", 100, block=100)
    assert _set(numbered.select("seq", "n")) == sorted(((v, 101 + i) for i, v in enumerate(sorted(values))), key=str)
    assert "SinglePartition" not in plan_of(numbered)
    after = keyed.upsert_with_ids(_base(spark), rows, "id", "seq")
    assert "SinglePartition" not in plan_of(after)
    assert after.count() == 3 + len(values) and after.agg({"id": "max"}).first()[0] == 5 + len(values)
    assert keyed.number_rows(rows.limit(0), "seq", "n", 3).count() == 0


def test_settling_bucketed_tables_shuffles_only_callbacks(spark, folder, tmp_path):
    tables = write_lead_tables(site.entries(spark, folder), site.lead_meta(spark, folder), site.order_lines(spark, folder),
                               "by_lead", str(tmp_path / "by_lead"))
    calls, feeds = site.callbacks(spark, folder), site.feeds(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        settled = settle_colocated(calls, tables, feeds)
        above = _exchanges_above(settled, "by_lead")
        assert len(above) >= 3 and not any(above)
        wanted = settle_callbacks(calls, site.entries(spark, folder), site.lead_meta(spark, folder), feeds,
                                  order_totals(site.order_lines(spark, folder)))
        same = [c for c in wanted.columns if c not in ("answers", "feed")]
        assert _set(settled.select(*same)) == _set(wanted.select(*same)) and settled.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        drop_lead_tables(spark, tables)


def _exchanges_above(df, name):
    """For each scan of tables of a name, whether an exchange comes before the first join above it."""
    lines, out = plan_of(df).split("\n\n")[0].splitlines(), []
    depth = lambda line: len(line) - len(line.lstrip(" +-:"))
    for i, line in enumerate(lines):
        if "Scan" in line and name in line:
            at, met = depth(line), []
            for upper in reversed(lines[:i]):
                if depth(upper) < at:
                    at = depth(upper)
                    met.append(upper)
                    if "Join" in upper:
                        break
            out.append(any("Exchange" in m for m in met))
    return out
