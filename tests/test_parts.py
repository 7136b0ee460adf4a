"""Shapes, rules, levels, names, reports and sources on hand-made frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import levels as lv
from riskspark.functions import names as nm
from riskspark.functions import scores as sc
from riskspark.operators import branches, clusters, reports, rules, screening, shape
from riskspark.operators.rules import Rule
from riskspark.sources import generate, tables


def one(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_save_and_load_all_formats(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("gone", T.DoubleType())])
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    for fmt in ("parquet", "csv", "json", "orc"):
        tables.save(df, str(tmp_path / f"t.{fmt}"), schema, fmt)
        back = tables.load(spark, str(tmp_path), "t", fmt, schema)
        assert back.schema.fieldNames() == ["id", "name", "gone"]
        assert sorted((r.id, r.gone) for r in back.collect()) == [(1, None), (2, None)]


def test_shapes(spark):
    df = spark.createDataFrame([("None", float("nan"), True, dt.date(2020, 1, 2)), ("x", 1.0, False, None)], "t string, d double, b boolean, day date")
    assert one(shape.clean_nulls(df), "t", "d") == [(None, None), ("x", 1.0)]
    assert one(shape.drop_types(df), "*") == [("None", pytest.approx(float("nan"), nan_ok=True), "True"), ("x", 1.0, "False")]
    with pytest.raises(ValueError):
        shape.prune(df, ["nope"])
    with pytest.raises(ValueError):
        shape.require_rows(df, 3)
    with pytest.raises(TypeError):
        shape.to_ts(df, "b")
    assert one(shape.to_ts(df, "day"), "day")[0][0] == dt.datetime(2020, 1, 2)
    assert shape.drop_sparse(spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string"), 40).columns == ["a"]
    assert shape.union_if_same(df, df.drop("t")).count() == 2


def test_active_and_idle_rows(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 5.0), (3, None, None)], "id int, i double, o double")
    on, off = shape.split_activity(df, "i", "o")
    assert [r.id for r in on.collect()] == [2] and sorted(r.id for r in off.collect()) == [1, 3]


def test_rule_texts(spark):
    df = spark.createDataFrame([(1, "Abc", 5.0, 50.0, True), (2, None, None, 10.0, None), (3, "x", 10.0, 3.0, False)], "id int, t string, a double, b double, f boolean")

    def hits(condition, value, features):
        return [r[0] for r in df.select(rules.hit(Rule("r", "Static", "i", condition, value, features, 1.0), df.columns)).collect()]
    assert hits("==", "aBC", "t") == [True, False, False]
    assert hits("==", "5", "a") == [True, False, False]
    assert hits("IN", "x, y", "t") == [False, False, True]
    assert hits("IN BETWEEN", "5,11", "a") == [False, False, True]
    assert hits("IN BETWEEN", "2,6", "a, b, ALL") == [False, False, False]
    assert hits("IN BETWEEN", "2,6", "a, b, ANY") == [True, False, True]
    assert hits("==", "true", "f") == [True, False, False]
    assert hits("<", "b", "a") == [True, False, False]
    for bad in (("<", "[]", "a"), ("==", "1", "zz"), ("IN BETWEEN", "1", "a"), ("~", "1", "a")):
        with pytest.raises(rules.RuleError):
            hits(*bad)
    with pytest.raises(rules.RuleError):
        rules.parse_indicator("nothing to infer", "x")


def test_levels_at_their_borders(spark):
    df = spark.createDataFrame([(0.8,), (0.2,), (0.5,), (0.1,), (0.9,), (None,)], "s double")
    s = F.col("s")
    assert one(df, lv.level_hml(s, 0.8, 0.2)) == [("High",), ("Medium",), ("Medium",), ("Low",), ("High",), ("Low",)]
    assert one(df, lv.level_tag(s, 0.8, 0.2)) == [("High",), ("Low",), ("Medium",), ("Low",), ("High",), ("Medium",)]
    assert one(df, lv.level_int(s, 0.8, 0.2)) == [(1,), (1,), (1,), (0,), (2,), (None,)]


def test_votes_and_weights(spark):
    df = spark.createDataFrame([("High", "Low", "Low", None, 1.0, None), ("High", "Low", None, None, None, None), ("Medium", "Low", None, None, 0.5, 0.1),
                                (None, None, None, None, None, None)], "a string, b string, c string, d string, x double, y double")
    levels = [F.col(c) for c in "abcd"]
    assert one(df, lv.level_vote(levels)) == [("Low",), ("High",), ("Medium",), ("High",)]
    assert one(df, lv.level_max(levels)) == [("High",), ("High",), ("Medium",), (None,)]
    assert one(df, sc.weighted_by_flow([F.col("x"), F.col("y")], [1.0, 3.0])) == [(100.0,), (None,), (pytest.approx(20.0),), (None,)]


def test_names(spark):
    df = spark.createDataFrame([("SMITH, John-Paul", "john paul smith"), (None, "x"), ("abc", "abc")], "a string, b string")
    a, b = F.col("a"), F.col("b")
    assert one(df, nm.normalise(nm.comma_flip(a)))[0] == ("JOHN PAUL SMITH",)
    assert one(df, nm.token_sort_ratio(nm.comma_flip(a), b)) == [(1.0,), (0.0,), (1.0,)]
    assert one(df, nm.token_count(a)) == [(2,), (0,), (1,)]
    assert one(df, nm.subset_ratio(a, b))[1:] == [(None,), (1.0,)]
    assert one(spark.createDataFrame([("a; b ;;a",)], "n string"), nm.unique_names(F.col("n"))) == [("a;b",)]
    short = spark.createDataFrame([("ab", "abc")], "a string, b string")
    assert one(short, nm.ngram_score(a, b, 3)) == [(0.0,)] and one(short, nm.ngram_score(a, b, 1))[0][0] == pytest.approx(2 / 3)
    assert one(short, nm.alias_best(a, F.lit("zz;AB,x"))) != [(None,)] and one(short, nm.alias_best(a, F.lit(""))) == [(None,)]


def test_block_join_is_exact_with_a_hot_word(spark):
    words = ["HOT", "A", "B", "C", "D", "E"]
    left = [" ".join(["HOT"] * (i % 3 == 0) + [words[1 + (i * k) % 5] for k in (1, 2, 3)]) for i in range(40)] + ["HOT", "HOT HOT"]
    right = [" ".join([words[(i * k) % 6] for k in (1, 3)]) for i in range(30)]
    lf, rf = (spark.createDataFrame([(x,) for x in v], "n string") for v in (left, right))
    for t in (0.34, 0.5, 0.67, 1.0):
        want = {(x, y) for x in set(left) for y in set(right) if len(set(x.split()) & set(y.split())) / len(set(x.split()) | set(y.split())) >= t - 1e-9}
        assert {(r.l_name, r.r_name) for r in screening.block_join(lf, rf, "n", "n", t).collect()} == want


def test_buckets_and_histogram_percentile(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.5, 1.0, 2.0, 2.5)], "x double")
    assert [r[0] for r in one(df, clusters.bucket(F.col("x"), [0.0, 1.0, 2.0]))] == [None, 0, 0, 1, 1, None]
    edges, dens = F.array(*[F.lit(v) for v in (0.0, 1.0, 2.0)]), F.array(F.lit(0.25), F.lit(0.75))
    assert [r[0] for r in one(df, clusters.hist_percentile(edges, dens, F.col("x")))] == [0.0, 0.0, 0.125, 0.25, 1.0, 1.0]


def test_histogram_counts_every_value_and_empty_columns(spark):
    rows = [("a", 1.0, None, 5.0), ("a", 2.0, None, 5.0), ("a", 9.0, None, None), ("b", 9.0, None, 5.0), ("c", None, None, None), (None, 5.0, None, 5.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double")
    splits = clusters.equal_width_splits(df, ["x", "y", "z"], 4)
    assert splits == {"x": [1.0, 3.0, 5.0, 7.0, 9.0], "y": [], "z": [5.0, 7.5, 10.0, 12.5, 15.0]}
    got = {(r.g, r.feature, r.bin): (r.n, r.total, r.density) for r in clusters.histogram(df, "g", ["x", "y", "z"], splits).collect()}
    assert {k[1] for k in got} == {"x", "z"} and len(got) == 4 * 2 * 4
    assert [got["a", "x", i] for i in range(4)] == [(2, 3, 2 / 3), (0, 3, 0.0), (0, 3, 0.0), (1, 3, 1 / 3)]
    assert got["b", "x", 3] == (1, 1, 1.0) and got["c", "x", 0] == (0, 0, None) and got[None, "x", 2] == (1, 1, 1.0)


def test_cluster_quality_of_odd_clusters(spark):
    def measures(rows):
        return tuple(clusters.cluster_quality(spark.createDataFrame(rows, "g int, x double, y double"), "g", ["x", "y"]).first())

    assert measures([(1, 0.0, 0.0), (1, 1.0, 0.0)]) == (None, None, None)
    two = [(1, 0.0, 0.0), (1, 2.0, 0.0), (2, 10.0, 0.0), (2, 12.0, 0.0)]
    s, ch, db = measures(two)
    assert s > 0.9 and ch == pytest.approx(50.0) and db == pytest.approx(0.2)
    assert measures([*two, (None, 3.0, 3.0)]) == (s, ch, db)
    assert measures([(1, 0.0, 0.0), (1, 2.0, 0.0), (2, 1.0, -1.0), (2, 1.0, 1.0)])[2] is None     # one centre
    assert measures([(1, 0.0, 0.0), (2, 2.0, 0.0)])[1] is None                                       # points


def test_branches_versions_and_codes(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(1, "b")], "model_id int, rule string")
    assert sorted((r.rule, r.branch_id, r.to_cluster) for r in branches.branch_split(df, 3).distinct().collect()) == [("a", 2, 1), ("b", 1, 0)]
    assert branches.ensure_prob(spark.createDataFrame([(0.4,)], "p1 double"), "p0", "p1").columns == ["p1", "p0"]
    assert reports.next_version(spark.createDataFrame([], "version double"), {}).first()[0] == 1.0
    codes = spark.createDataFrame([("x_{}kto{}k", "from {} to {}"), ("plain", "p {}")], "code string, description string")
    assert sorted(one(reports.expand_codes(codes, {"kto": [45, 50]}), "code", "description")) == [("plain", "p {}"), ("x_45kto50k", "from 45 to 50")]


def test_generated_rows_repeat_and_keep_their_rules(spark):
    parties = generate.party_ids(spark, 200)
    links = generate.party_links(parties, 200)
    assert links.filter("party = linked_party").count() == 0 and links.count() > 20
    a = generate.alerts(parties).orderBy("alert").collect()
    assert a == generate.alerts(parties.repartition(7)).orderBy("alert").collect() and len(a) == 200 * 2 * 4
    assert all(r.closed > r.created for r in a)
    people = generate.customers(parties)
    assert 0.8 < people.filter("party_type = 'I'").count() / 200 < 0.98
