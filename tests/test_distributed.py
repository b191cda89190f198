"""Row numbers, running sums and Bloom-filtered membership against plain computation."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from conftest import records
from pyspark.sql import functions as F

from occspark.operators import grid, marks, membership, profile
from occspark.operators.dedupe import observed_dedupe
from occspark.operators.rownumber import largest_rows, row_numbers, running_sums
from occspark.plans import cubes
from occspark.plans import tables as jobs
from occspark.schema import OCCURRENCE_SCHEMA, conform
from occspark.sources import tables
from occspark.sources.star_view import occurrences


def test_row_numbers_follow_the_order_over_many_partitions(spark):
    draw = random.Random(1)
    values = [draw.choice([None, *range(50)]) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(7)
    rows = records(row_numbers(df, ["v", "id"], "n").withColumn("p", F.spark_partition_id()))
    wanted = sorted(range(600), key=lambda i: (values[i] is None, values[i] or 0, i))
    assert [r["id"] for r in sorted(rows, key=lambda r: r["n"])] == wanted
    assert sorted(r["n"] for r in rows) == list(range(1, 601))


def test_row_numbers_of_copies_and_one_hot_value(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(0,)] * 20, "v int").repartition(4)
    numbered = row_numbers(df, ["v"], "n")
    rows = records(numbered)
    assert sorted(r["n"] for r in rows) == list(range(1, 521))
    assert {r["v"] for r in rows if r["n"] <= 20} == {0}
    assert row_numbers(df.limit(0), ["v"]).count() == 0


def test_names_that_the_operator_uses_inside_may_be_taken(spark):
    df = spark.createDataFrame([(3, 1, 2, 4), (1, 5, 6, 7)], "_at int, _place int, _base int, _tie int")
    rows = records(row_numbers(df, ["_at"], "n"))
    assert {(r["_at"], r["_place"], r["n"]) for r in rows} == {(1, 5, 1), (3, 1, 2)}
    sums = records(running_sums(df, ["_tie"], ["_at"], "_base", "_run"))
    assert {(r["_tie"], r["_run"]) for r in sums} == {(4, 0), (7, 0)}


def test_running_sums_of_a_key_that_holds_most_rows(spark):
    draw = random.Random(2)
    rows = [("hot" if draw.random() < 0.7 else draw.choice(["a", "b", None]), i, draw.randrange(5)) for i in range(400)]
    got = {r["i"]: r["before"] for r in records(running_sums(spark.createDataFrame(rows, "k string, i int, v long"), ["k"], ["i"], "v"))}
    total: dict = defaultdict(int)
    wanted = {}
    for k, i, v in rows:
        wanted[i] = total[k]
        total[k] += v
    assert got == wanted


def test_membership_is_exact_and_few_other_rows_pass_the_filter(spark):
    small = spark.createDataFrame([(f"k{i}",) for i in range(0, 3_000, 3)] + [(None,)], "key string")
    large = spark.range(50_000).select(F.concat(F.lit("k"), (F.col("id") % 25_000) * 2).alias("key"), "id")
    passed = membership.prefiltered(large, small, "key")
    hits = {f"k{i}" for i in range(0, 3_000, 6)}
    found = Counter(r["key"] for r in passed.collect())
    assert hits <= set(found) and all(found[k] == 2 for k in hits)
    assert len(set(found) - hits) < 0.02 * 25_000
    assert {r["key"] for r in membership.semi_join(small, large, "key").collect()} == hits
    rest = [r["key"] for r in membership.anti_join(small, large, "key").collect()]
    assert Counter(rest) == Counter([None, *({f"k{i}" for i in range(0, 3_000, 3)} - hits)])


def test_without_keys_or_beyond_the_bound(spark):
    large = spark.createDataFrame([("a",), (None,)], "key string")
    none = large.limit(0)
    assert membership.prefiltered(large, none, "key").count() == 0
    assert membership.prefiltered(large, large, "key", most_blocks=0).count() == 2
    assert membership.semi_join(none, large, "key").count() == 0


def _cells(draw, rows=1_500):
    kinds = [draw.choice(["a", "b", "c", None]) for _ in range(rows)]
    skewed = [f"v{min(int(draw.expovariate(0.05)), 400)}" for _ in range(rows)]
    unique = [f"u{i}" for i in range(rows)]
    flag = [draw.choice([True, False, None]) for _ in range(rows)]
    group = [draw.choice(["x", "y"]) for _ in range(rows)]
    return list(zip(group, kinds, skewed, unique, flag, strict=True))


@pytest.mark.parametrize("keys", [(), ("group",)])
@pytest.mark.parametrize("most", [None, 20])
def test_leading_values_equal_a_full_count(spark, keys, most, monkeypatch):
    monkeypatch.setattr(profile.leading_values, "__defaults__", (64,))
    rows = _cells(random.Random(3))
    df = spark.createDataFrame(rows, "group string, kind string, skewed string, unique string, flag boolean").repartition(5)
    full: dict = defaultdict(Counter)
    for group, *cells in rows:
        if not keys:
            full[(), "group"][group] += 1
        for column, value in zip(("kind", "skewed", "unique", "flag"), cells, strict=True):
            text = str(value).lower() if isinstance(value, bool) else value
            full[(group,) if keys else (), column][text] += 1
    wanted = {}
    for (key, column), counts in full.items():
        if most is None or len(counts) <= most:
            order = sorted(counts.items(), key=lambda c: (-c[1], c[0] is None, c[0] or ""))
            wanted |= {(*key, column, i + 1): c for i, c in enumerate(order[:10])}
    found = records(profile.top_values(df, keys=keys, max_categories=most))
    assert {(*[r[k] for k in keys], r["column"], r["rank"]): (r["value"], r["count"]) for r in found} == wanted


def test_only_buckets_that_reach_the_bound_are_counted(spark):
    rows = [(f"hot{i % 12}",) for i in range(6_000)] + [(f"rare{i}",) for i in range(3_000)]
    df = spark.createDataFrame(rows, "v string")
    counted = profile.leading_values(df, (), ["v"], 10)
    assert counted.count() < 200  # of 3,012 values
    assert profile.top_values(df.limit(0)).count() == 0
    assert profile.top_values(df.limit(0), max_categories=5).count() == 0
    assert profile.top_values(spark.range(3)).count() == 0


@pytest.mark.parametrize("most", [None, 20])
def test_top_values_read_every_row_once(spark, most):
    rows, read = _cells(random.Random(4)), spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    schema = "group string, kind string, skewed string, unique string, flag boolean"
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(counted), schema)
    assert profile.top_values(df, max_categories=most).count()
    assert read.value == len(rows)


def _first_scan_below(plan: str, exchange: str) -> str:
    return plan.split(exchange, 1)[1].split("FileScan parquet", 1)[1].split("]", 1)[0]


def test_order_lines_are_not_shuffled_by_customer_nor_with_names_of_parts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = occurrences(spark, "/root/testdata/sf0.001")
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "o_custkey" in _first_scan_below(plan, "Exchange hashpartitioning(o_custkey")
    by_supplier = plan.index("Exchange hashpartitioning(l_suppkey")
    assert plan.index("Exchange hashpartitioning(l_partkey") < by_supplier < plan.index("Exchange hashpartitioning(l_orderkey")


@pytest.mark.parametrize("limit", [1, 60, 200, 999, 1_000, 5_000])
def test_largest_rows_beyond_one_task(spark, limit):
    draw = random.Random(9)
    rows = [(i, draw.choice([1, 1, 1, 2, 3, 40, 50])) for i in range(1_000)]
    df = spark.createDataFrame(rows, "id int, n long").repartition(6)
    found = largest_rows(df, "n", ["id"], limit, one_task=50)
    assert [(r["id"], r["n"]) for r in found.collect()] == sorted(rows, key=lambda r: (-r[1], r[0]))[:limit]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("TakeOrderedAndProject" in plan) == (limit <= 50)


def test_profile_counts_the_values_of_a_row_once(spark):
    rows, read = _cells(random.Random(5)), spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    schema = "family string, basisOfRecord string, scientificName string, uuid string, flag boolean"
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).map(counted), schema)
    report = profile.profile(df)
    assert report.column_profile.count() == 5 and report.top_values.count() and report.top_values.collect()
    assert read.value == len(rows)


@pytest.mark.parametrize("files", [1, 7])
def test_stored_rows_are_deduped_without_shuffling_them_whole(spark, tmp_path, files):
    n = F.col("id")
    rows = spark.range(20_000).select(
        F.when(n % 3 == 0, "hot").when(n % 7 == 0, "").when(n % 5 > 0, (n % 9_000).cast("string")).alias("uuid"),
        F.when(n % 11 != 0, F.xxhash64("id") % 50).alias("eventDate"),
        (n % 4).cast("string").alias("query_species_key"),
        (n % 6_000).cast("string").alias("scientificName"),
        n.cast("string").alias("vernacularName"),
    )
    path = str(tmp_path / "odd name=%")
    tables.write_table(rows.repartition(files), path, row_group_rows=3_000)
    stored = tables.read_table(spark, path)
    kept, before, after = observed_dedupe(stored)
    assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    found = kept.collect()
    order = ("uuid", "eventDate", "query_species_key")

    def ranked(r):
        key = "uuid:" + r["uuid"] if r["uuid"] else f"fp:{r['scientificName']}|{r['eventDate']}"
        return key, (r["eventDate"] is None, r["eventDate"], r["query_species_key"], r["uuid"] is None)

    first = {}
    for r in stored.collect():
        key, place = ranked(r)
        first[key] = min(first.get(key, place), place)
    assert dict(map(ranked, found)) == first and len(found) == len(first)
    assert (before.get["rows"], after.get["rows"]) == (20_000, len(first))
    assert kept.columns == rows.columns and kept.exceptAll(stored).isEmpty()
    whole, _, counted = observed_dedupe(stored, most_blocks=1)
    assert sorted(map(str, whole.select(*order).collect())) == sorted(map(str, kept.select(*order).collect()))
    whole.collect()
    assert counted.get["rows"] == len(first)


def test_places_at_the_edges_of_words_and_blocks(spark, tmp_path):
    path = str(tmp_path / "rows")
    for n in (1, 4_096, 8_200):  # files of less, exactly and more than a block
        spark.range(n).coalesce(1).write.mode("append").parquet(path)
    rows = spark.read.parquet(path)
    files = marks.file_blocks(rows)
    assert files.selectExpr("max(_base)").first()[0] <= 4 and marks.file_blocks(rows, 4) is None
    assert marks.file_blocks(rows, 5).count() == 3
    placed = marks.with_place(rows, files, "at")
    assert placed.select("at").distinct().count() == 12_297
    wanted = [r["at"] for r in placed.where("id in (0, 31, 32, 63, 64, 4095, 4096, 8191, 8192, 8199)").collect()]
    picked = marks.marked(placed, placed.where(F.col("at").isin(wanted)).select("at"), "at")
    assert sorted(r["id"] for r in picked.collect()) == sorted(
        [0] * 3 + [31, 32, 63, 64, 4095] * 2 + [4096, 8191, 8192, 8199]
    )
    assert marks.marked(placed, placed.limit(0).select("at"), "at").isEmpty()


def test_csv_copy_of_a_merged_table_is_compressed(spark, tmp_path):
    rows = spark.range(5_000).select(F.col("id").cast("string").alias("uuid"), F.lit('a "b", c').alias("genus"))
    tables.write_table(conform(rows, OCCURRENCE_SCHEMA), str(tmp_path / "in"))
    jobs.merge_tables(spark, [str(tmp_path / "in")], str(tmp_path / "out"), csv=str(tmp_path / "csv"))
    parts = [p for p in (tmp_path / "csv").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    read = spark.read.option("header", True).option("escape", '\\').csv(str(tmp_path / "csv"))
    assert read.select("uuid", "genus").exceptAll(rows).isEmpty() and read.count() == 5_000


@pytest.mark.parametrize("listed", [False, True])
def test_stored_cube_is_shuffled_once_for_its_groups_and_their_order(spark, tmp_path, monkeypatch, listed):
    n = F.col("id")
    rows = spark.range(6_000).select(
        F.when(n % 3 == 0, "hot").when(n % 11 != 0, (n % 41).cast("string")).alias("scientificName"),
        F.when(n % 5 != 0, F.lit("f")).alias("family"),
        F.when(n % 7 != 0, (n % 60).cast("string")).alias("taxonConceptID"),
        (F.lit(1990) + n % 3).alias("year"),
        F.when(n % 4 == 0, -0.04).when(n % 4 == 1, 0.04).when(n % 4 == 2, float("nan")).alias("decimalLatitude"),
        F.when(n % 10 != 0, n % 2 * 100.0).alias("decimalLongitude"),
        *([F.when(n % 3 == 0, "Rare").alias("state_status")] if listed else []),
    )
    tables.write_table(rows, str(tmp_path / "rows"))
    plans, write = {}, tables.write_table

    def watched(df, path, *more):
        plans[path.rsplit("/", 1)[-1]] = df._jdf.queryExecution().executedPlan().toString()
        write(df, path, *more)

    monkeypatch.setattr(tables, "write_table", watched)
    cubes.build_grid_cube(spark, str(tmp_path / "rows"), str(tmp_path / "cube"), decimals=1)
    assert plans["grid_bins"].count("Exchange ") == 2  # by concept, and by the order
    stored = spark.read.parquet(str(tmp_path / "cube" / "grid_bins"))
    plain = grid.grid_cube(rows, 1)
    assert stored.schema.names == plain.schema.names and set(grid.CUBE_ORDER) <= set(stored.columns)
    wanted = grid.cube_order(plain).collect()
    parts = sorted(str(p) for p in (tmp_path / "cube" / "grid_bins").glob("part-*"))
    in_files = [str(r) for p in parts for r in spark.read.parquet(p).coalesce(1).collect()]
    assert len(wanted) > 100 and in_files == list(map(str, wanted))
    counts, concepts = Counter(), defaultdict(set)
    keys = ("scientificName", "family", "year", *(["state_status"] if listed else []))
    for r in rows.where("decimalLatitude IS NOT NULL AND decimalLongitude IS NOT NULL").collect():
        place = (str(abs(round(r["decimalLatitude"], 1))), r["decimalLongitude"])
        counts[place, *[r[k] for k in keys]] += 1
        concepts[place, *[r[k] for k in keys]].add(r["taxonConceptID"])
    found = {
        ((str(abs(r["lat_bin"])), r["lon_bin"]), *[r[k] for k in keys]): (r["record_count"], r["distinct_taxon_concepts"])
        for r in wanted
    }
    assert found == {k: (c, len(concepts[k])) for k, c in counts.items()} and len(found) == len(wanted)
