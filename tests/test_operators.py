import re

import pytest
from pyspark.sql import functions as F

from bazaarlake import contract
from bazaarlake.operators import calendar as cal
from bazaarlake.operators import quality
from bazaarlake.operators.dedup import duplicate_keys, keep_first
from bazaarlake.operators.distinct import distinct_counts
from bazaarlake.operators.joins import Lookup, flag_orphans, with_default
from bazaarlake.operators.keys import dense_keys, extend_keys, number_written
from bazaarlake.operators.references import Link, audit_links
from bazaarlake.operators.ranking import highest, lowest, top_n
from bazaarlake.operators.sampling import fixed_size_sample
from bazaarlake.plans import source_model


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- quality -------------------------------------------------------------------------


def test_every_row_lands_on_one_side(spark):
    df = spark.createDataFrame([(None,), (-1,), (0,), (1,)], "v int")
    valid, rejected = quality.split_invalid(df, F.col("v") < 0, "t", "it's bad")
    assert rows(valid, "v") == [(0,), (1,)]
    assert rows(rejected, "record_data", "reason") == [('{"v":-1}', "it's bad"), ('{"v":null}', "it's bad")]


@pytest.mark.parametrize("strategy", [None, "merge"])
@pytest.mark.parametrize("optional", [False, True])
def test_reference_split(spark, strategy, optional):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "x"), (5, "b")], "i int, fk string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "pk string")
    valid, rejected = quality.split_orphans(child, parent, "fk", "pk", "t", "r", optional, strategy)
    good = [(1,), (3,), (5,)] if optional else [(1,), (5,)]
    assert rows(valid, "i") == good
    assert rejected.count() == 5 - len(good)


def test_cascade_equals_one_rule_after_the_other(spark):
    data = [(i, i % 7 - 2 if i % 5 else None, f"k{i % 4}" if i % 6 else None) for i in range(200)]
    df = spark.createDataFrame(data, "i int, v int, fk string")
    parent = spark.createDataFrame([("k0",), ("k1",), ("k2",)], "pk string")
    rules = [*quality.missing("first", "v"), quality.Rule("negative", "v < 0", "second")]
    ref = contract.Reference("fk", "p", "pk", "third")
    for limit in (None, 0):
        tagged = quality.assess(df, rules, (ref,), {"p": parent}, [quality.Rule("four", "v = 4", "last")], limit)
        rest, expected = df, {}
        for rule in rules:
            rest, bad = quality.split_invalid(rest, F.expr(rule.invalid), "t", rule.reason)
            expected[rule.reason] = bad.count()
        rest, bad = quality.split_orphans(rest, parent, "fk", "pk", "t", "third")
        expected["third"] = bad.count()
        rest, bad = quality.split_invalid(rest, F.col("v") == 4, "t", "last")
        expected["last"] = bad.count()
        got = tagged.rejected("t", F.lit("")).groupBy("reason").count()
        assert {r[0]: r[1] for r in got.collect()} == expected
        assert rows(tagged.accepted(["i"]), "i") == rows(rest, "i")


def test_contract_rules(spark):
    table = contract.Table("t", (contract.text("a", 3), contract.text("b", 2, required=False)), key=("a",))
    df = spark.createDataFrame([("abc", "x"), ("abcd", None), (None, "xyz")], "a string, b string")
    counts = quality.rule_counts(df, "t", quality.required_rules(table) + quality.length_rules(table))
    assert rows(counts, "rule_id", "nb_lignes") == [("a_null", 1), ("a_too_long", 1), ("b_too_long", 1)]


def test_audits(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "z"), (3, None)], "k int, fk string")
    parent = spark.createDataFrame([("a",)], "pk string")
    audit = quality.key_audit({"t": df}, {"t": ["k"]})
    assert rows(audit, "nb_lignes", "nb_cles", "nb_surplus") == [(4, 3, 1)]
    audit = audit_links({"t": df, "p": parent}, [Link("t", "fk", "p", "pk", optional=True)])
    assert rows(audit, "nb_cles_orphelines", "nb_lignes_orphelines") == [(1, 1)]
    assert rows(duplicate_keys(df, ["k"]), "k", "nb_lignes") == [(1, 2)]


# --- joins: a third of the rows on one key, a third without key ------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 1700).cast("string"))
    )
    return spark.range(6000).select("id", key.alias("nk"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_known", [True, False])
@pytest.mark.parametrize("salts", [1, 8])
def test_shuffled_lookup_is_the_plain_join(spark, skewed, how, hot_known, salts):
    parent = spark.range(0, 1700, 2).select(F.concat(F.lit("k"), "id").alias("nk"), F.col("id").alias("sk"))
    if hot_known:
        parent = parent.unionByName(spark.createDataFrame([("hot", -1)], "nk string, sk long"))
    got = Lookup(parent, "nk", ["sk"], salts, "merge").attach(skewed, how)
    want = skewed.join(parent, "nk", how)
    assert got.columns == want.columns
    assert rows(got, "id", "nk", "sk") == rows(want, "id", "nk", "sk")


def test_orphan_flag_same_on_all_ways(spark, skewed):
    parent = spark.createDataFrame([("hot",), ("k2",), ("k2",)], "pk string")
    plain = flag_orphans(skewed, "nk", parent, "pk", "bad")
    salted = flag_orphans(skewed, "nk", parent, "pk", "bad", salts=4, strategy="merge")
    assert rows(plain, "id", "bad") == rows(salted, "id", "bad")
    assert plain.count() == 6000


def test_lookup_chain_reads_the_fact_once(spark, folder):
    """Three lookups and a reference check with broadcasting off: one scan of the fact, and no job while it is built."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    parts = spark.range(100).select(F.col("id").alias("l_partkey"), F.col("id").alias("sk"))
    suppliers = spark.range(10).select(F.col("id").alias("l_suppkey"), F.col("id").alias("ssk"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spark.sparkContext.setJobGroup("lookups", "lookups")
        out = Lookup(parts, "l_partkey", ["sk"]).attach(lines, "left")
        out = Lookup(suppliers, "l_suppkey", ["ssk"], salts=4).attach(out, "left")
        out = flag_orphans(out, "l_orderkey", spark.range(5), "id", "bad")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("lookups")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert plan.count("l_linenumber") and plan.count("Relation [l_orderkey") == 1


def test_with_default(spark):
    df = spark.createDataFrame([(1, "old"), (2, "old")], "k int, s string")
    values = spark.createDataFrame([(1, "new")], "k int, s string")
    assert rows(with_default(df, values, "k", "s", "none"), "k", "s") == [(1, "new"), (2, "none")]


# --- dedup, keys, ranking, sampling ---------------------------------------------------------------


def test_keep_first_is_fixed_and_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 7, "a"), (2, None, "z"), (2, 1, "y")], "k int, v int, s string")
    kept = keep_first(df, ["k"])
    assert rows(kept, "k", "v", "s") == [(1, 5, "a"), (2, None, "z")]
    assert rows(keep_first(df.repartition(3), ["k"]), "k", "v", "s") == rows(kept, "k", "v", "s")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # one before and one after the exchange


def test_dense_keys(spark):
    df = spark.range(1000).select(F.concat(F.lit("n"), "id").alias("nk")).repartition(4)
    numbered = dense_keys(df, ["nk"], "sk")
    assert [r[0] for r in numbered.select("sk").orderBy("sk").collect()] == list(range(1, 1001))
    again = dense_keys(df.repartition(7), ["nk"], "sk")
    assert rows(numbered, "nk", "sk") == rows(again, "nk", "sk")


def test_extend_keys_keeps_known_numbers(spark):
    known = spark.createDataFrame([("a", 7), ("gone", 3)], "nk string, sk long")
    now = spark.createDataFrame([("a",), ("b",), ("c",), ("b",), (None,)], "nk string")
    got = dict(rows(extend_keys(known, now, "nk", "sk"), "nk", "sk"))
    assert got["a"] == 7 and got["gone"] == 3 and sorted([got["b"], got["c"]]) == [8, 9] and len(got) == 4


def test_ranking_puts_null_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1), ("c", 3), ("d", 3)], "k string, v int")
    assert [r[0] for r in top_n(df, "v", 4, "k").collect()] == ["c", "d", "b", "a"]
    assert highest(df, "v", "k").first()[0] == "c" and lowest(df, "v", "k").first()[0] == "b"


def test_sample_has_the_exact_size(spark):
    df = spark.range(5000)
    for size in (0, 1, 37, 5000):
        picked = fixed_size_sample(df, ["id"], seed=1, rows=size)
        assert picked.count() == picked.distinct().count() == size
    part = fixed_size_sample(df, ["id"], seed=1, fraction=0.02)
    assert part.count() == 100
    assert rows(part, "id") == rows(fixed_size_sample(df.repartition(5), ["id"], seed=1, rows=100), "id")
    assert rows(part, "id") != rows(fixed_size_sample(df, ["id"], seed=2, rows=100), "id")


# --- calendar ----------------------------------------------------------------------------------------


def test_warehouse_calendar(spark):
    days = cal.warehouse_calendar(spark)
    assert days.count() == 2557
    first = days.where("temps_sk = 20240101").first()
    assert (first.jour_semaine_num, first.jour_semaine_nom, first.mois_nom, first.est_ferie) == (2, "Monday", "January", False)


def test_source_calendar_has_holidays(spark):
    days = cal.source_calendar(cal.date_bounds(spark, "2024-01-01", "2024-12-31"))
    assert days.count() == 366 and days.where("est_ferie").count() == 12
    first = days.where("temps_sk = 20240101").first()
    assert (first.jour_semaine_num, first.jour_semaine_nom, first.est_jour_ouvre) == (0, "Lundi", False)
    assert dict(zip(days.columns, days.dtypes)).keys() == set(contract.CALENDAR.names)


def test_spines(spark):
    bounds = cal.date_bounds(spark, "2024-01-15", "2024-03-01")
    assert [str(r[0]) for r in cal.month_starts(bounds).collect()] == ["2024-01-01", "2024-02-01", "2024-03-01"]
    products = spark.createDataFrame([("p1",), ("p2",)], "produit_nk string")
    stores = spark.createDataFrame([(f"s{i}",) for i in range(5)], "magasin_nk string")
    stock = spark.createDataFrame(
        [("2024-02-01", "p1", "s3", 4), ("2024-02-01", "p2", "s3", 6), ("2024-03-01", "p1", "s0", None)],
        "date_snapshot string, produit_nk string, magasin_nk string, quantite_en_stock int",
    ).withColumn("date_snapshot", F.to_date("date_snapshot"))
    got = cal.stock_coverage(stock, products, stores, bounds)
    filled = {(str(r[0]), r[1]): tuple(r[2:]) for r in got.collect()}
    assert len(filled) == 15 and filled.pop(("2024-02-01", "s3")) == (2, 0, 10) and set(filled.values()) == {(2, 2, 0)}


def test_calendar_fits_the_facts(spark):
    days = spark.createDataFrame([("1995-03-04", "1996-01-01"), ("0001-01-01", None), ("2999-12-31", "1995-01-01")], "a string, b string")
    typed = days.select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    bounds = cal.fitted_bounds({"x": (typed, ["a"]), "y": (typed, ["a", "b"])}, "1970-01-01", "2069-12-31")
    assert [str(v) for v in bounds.first()] == ["1995-01-01", "1996-12-31"]
    empty = cal.fitted_bounds({"x": (typed.where("false"), ["a"])}, "1970-01-01", "2069-12-31")
    assert cal.calendar(empty).count() == 0


# --- references, distinct counts, line keys -----------------------------------------------------------


def test_all_links_in_one_audit(spark):
    child = spark.createDataFrame([("a", "x"), ("b", None), ("b", "y"), (None, "y"), ("a", "x")], "k string, o string")
    other = spark.createDataFrame([("c",), ("x",)], "k string")
    parent = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    links = [
        Link("s.child", "k", "s.parent", "k"), Link("s.child", "o", "s.other", "k", optional=True), Link("s.other", "k", "s.parent", "k"),
        Link("s.child", "o", "s.parent", "k"),
    ]
    got = audit_links({"s.child": child, "s.other": other, "s.parent": parent}, links)
    assert rows(got, *got.columns) == sorted([
        ("s.child", "k", "s.parent", 1, 2, 1), ("s.child", "o", "s.other", 1, 2, 0), ("s.other", "k", "s.parent", 2, 2, 0),
        ("s.child", "o", "s.parent", 2, 4, 1),
    ])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(target#\d+, key#", plan)) == 1


def test_distinct_counts_by_bitmap(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") % 5 > 0, F.col("id") * 7 + 1).alias("a"), (F.col("id") % 3 + 1).alias("b"), F.lit(2).alias("v")
    )
    counted = distinct_counts(df, {"na": "a", "nb": "b"}, {"n": F.lit(1), "v": F.col("v")})
    assert counted.first().asDict() == {"n": 50_000, "v": 100_000, "na": 40_000, "nb": 3}
    assert "Expand" not in counted._jdf.queryExecution().executedPlan().toString()
    none = distinct_counts(df.where("id < 0"), {"na": "a"}, {"v": F.col("v")}).first()
    assert (none.v, none.na) == (None, 0)


def test_numbering_written_rows_never_shuffles_them(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5_000, 1, 5).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = number_written(spark, path, spark.range(1).schema, "sk")
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "SortMergeJoin" not in plan
        assert kept.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()[:] == (1, 5000, 5000)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bitmaps_are_built_by_key_not_by_combination(spark):
    bits = 32768
    df = spark.range(0, 4000, 1, 2).select((F.col("id") % 7 * bits + 1).alias("a"), (F.col("id") % 11 * bits + 1).alias("b"), "id")
    counted = distinct_counts(df, {"na": "a", "nb": "b"}, {"n": F.lit(1)})
    assert counted.first().asDict() == {"n": 4000, "na": 7, "nb": 11}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bitmap_construct_agg(") == 1  # 7 + 11 bitmaps, not 7 * 11 times two


def test_rows_are_numbered_where_they_lie(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 10_000, 1, 7).select("id", (F.col("id") % 4 == 0).alias("rejected"))
    df.write.partitionBy("rejected").parquet(path)
    kept = number_written(spark, path, df.schema, "sk", where="NOT rejected")
    assert kept.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk"), F.count("id")).first()[:] == (1, 7500, 7500, 7500)
    again = number_written(spark, path, df.schema, "sk", where="NOT rejected")
    assert kept.exceptAll(again).count() == 0
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan
    assert number_written(spark, path, df.schema, "sk", where="id < 0 AND rejected").count() == 0


# --- source model ----------------------------------------------------------------------------------------


def test_segments(spark):
    data = [("p", f"t{i}", 600, 1) for i in range(48)] + [("s", f"t{i}", 150, 1) for i in range(12)]
    data += [("o", "t1", 9000, 1), ("bad", "t1", 9000, 0)]
    sales = spark.createDataFrame(data, "client_nk string, ticket_nk string, montant_ttc int, quantite int")
    sales = sales.withColumn("montant_ttc", F.col("montant_ttc").cast("decimal(12,2)"))
    customers = spark.createDataFrame([(c, "?") for c in ("p", "s", "o", "bad", "none")], "client_nk string, segment string")
    got = dict(rows(source_model.assign_segments(customers, sales), "client_nk", "segment"))
    assert got == {"p": "Premium", "s": "Standard", "o": "Occasionnel", "bad": "Occasionnel", "none": "Occasionnel"}


def test_order_totals(spark):
    lines = spark.createDataFrame([("o1", 2), ("o1", 3), ("o2", 1)], "commande_nk string, montant_ligne_ht int")
    orders = spark.createDataFrame([("o1", 5), ("o2", 2), ("o3", 0)], "commande_nk string, montant_total_ht int")
    assert rows(source_model.order_total_audit(orders, lines), "commande_nk", "total_lignes_ht") == [("o2", 1)]


# --- facts meet dimensions -----------------------------------------------------------------


def test_unread_left_lookup_is_left_out(spark):
    fact = spark.createDataFrame([(1, "a", 10), (2, "x", 20), (3, None, 30)], "i int, k string, v int")
    parent = spark.createDataFrame([("a", 7), ("b", 8)], "k string, sk int")
    keyed = Lookup(parent, "k", ["sk"], one_row=True).attach(fact, "left")
    assert rows(keyed, "i", "sk") == [(1, 7), (2, None), (3, None)]
    unread = keyed.groupBy("i").agg(F.sum("v").alias("v"))
    assert "Join" not in unread._jdf.queryExecution().optimizedPlan().toString()
    assert rows(unread, "i", "v") == [(1, 10), (2, 20), (3, 30)]


def test_sales_meet_clients_once_and_stores_by_their_size(spark, folder):
    """A view that reads no client key joins clients for the check alone; gold's parents come from an aggregate of their key."""
    from checks.landing import Retailer

    sales = Retailer(spark, folder).gold["fait_ventes"].groupBy("magasin_sk").agg(F.sum("montant_ttc"))
    plan = sales._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join LeftOuter, \(client_nk", plan)) == 1
    assert re.search(r"Aggregate \[magasin_nk#\d+\], \[magasin_nk#\d+, min\(magasin_sk", plan)
