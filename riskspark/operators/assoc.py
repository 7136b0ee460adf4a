"""Association between features, feature groups and their typologies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from math import isfinite

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.components import connected_components
from riskspark.operators.ranks import ranked_values
from riskspark.sources.session import ensure_checkpoint_dir, written

UNKNOWN = "NA"


def fixed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The needed columns written once to the checkpoint folder: several passes read them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.select(*cols).checkpoint()


def _spearman(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    ranks = ranked_values(df, cols).select("feature", "value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot([key], list(cols), "feature", "value")
    wide = long.join(ranks, ["feature", "value"]).groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("rank"))).alias(c) for c in cols])
    pairs = list(combinations(cols, 2))
    row = wide.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(a).alias("f1"), F.lit(b).alias("f2"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])).alias("x")).select("x.*")


def spearman(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(f1, f2, r) for every pair of columns. Average ranks are made per distinct value, so
    equal values - however many - are one row until they are joined back."""
    return _spearman(fixed(df, [key, *cols]), key, cols)


def _cell(a: Column, b: Column, f1: str, f2: str) -> Column:
    def text(c: Column) -> Column:
        return F.coalesce(c.cast("string"), F.lit("null"))
    return F.struct(F.lit(f1).alias("f1"), F.lit(f2).alias("f2"), text(a).alias("a"), text(b).alias("b"))


def cramers_from_cells(cells: DataFrame) -> DataFrame:
    """(f1, f2, r) from contingency counts (f1, f2, a, b, n): Cramer's V with bias
    correction. The windows hold one row per category."""
    pair = ["f1", "f2"]
    wide = cells.withColumn("ra", F.sum("n").over(Window.partitionBy(*pair, "a"))).withColumn(
        "cb", F.sum("n").over(Window.partitionBy(*pair, "b")))
    s = wide.groupBy(*pair).agg(
        F.sum(F.col("n").cast("double") * F.col("n") / (F.col("ra").cast("double") * F.col("cb"))).alias("s"), F.sum("n").alias("n"),
        F.size(F.collect_set("a")).alias("r"), F.size(F.collect_set("b")).alias("k"))
    n1, r, k = F.col("n") - 1, F.col("r"), F.col("k")
    phi = F.greatest(F.lit(0.0), F.col("s") - 1 - (k - 1) * (r - 1) / n1)
    rc, kc = r - (r - 1) * (r - 1) / n1, k - (k - 1) * (k - 1) / n1
    v = F.sqrt(phi / F.greatest(F.least(rc - 1, kc - 1), F.lit(0.001)))
    return s.select(*pair, F.when((r == 1) & (k == 1), 1.0).otherwise(v).alias("r"))


def _count_cells(df: DataFrame, cells: Sequence[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*cells)).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n")).select("c.*", "n")


def cramers_v(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return cramers_from_cells(_count_cells(df, [_cell(F.col(a), F.col(b), a, b) for a, b in pairs]))


def _num_cat_v(df: DataFrame, nums: Sequence[str], cats: Sequence[str]) -> DataFrame:
    splits, names = [], []
    wide = df.select(*cats, *[F.col(n).cast("double").alias(n) for n in nums])
    for cat in cats:
        stats = wide.groupBy(cat).agg(*[F.array(
            F.avg(c) - F.stddev_pop(c), F.avg(c) + F.stddev_pop(c), F.min(c), F.max(c)).alias(c) for c in nums]).collect()
        for c in nums:
            splits.append([float("-inf"), *(sorted({v for r in stats for v in r[c] if v is not None and isfinite(v)}) or [0.0]), float("inf")])
            names.append((c, cat))
    cut = Bucketizer(splitsArray=splits, inputCols=[c for c, _ in names], outputCols=[f"_b_{c}_{k}" for c, k in names],
                     handleInvalid="keep").transform(wide)
    return cramers_from_cells(_count_cells(cut, [_cell(F.col(f"_b_{c}_{k}").cast("int"), F.col(k), c, k) for c, k in names]))


def num_cat_v(df: DataFrame, nums: Sequence[str], cats: Sequence[str]) -> DataFrame:
    """Numbers cut at every category's mean - sd, mean + sd, min and max (four numbers per
    category and feature on the driver), then Cramer's V."""
    return _num_cat_v(fixed(df, [*nums, *cats]), nums, cats)


def assoc_matrix(df: DataFrame, key: str, nums: Sequence[str], cats: Sequence[str]) -> DataFrame:
    """(f1, f2, r) for all pairs of features, one row per pair."""
    base = fixed(df, [key, *nums, *cats])
    out = _spearman(base, key, nums).unionByName(_num_cat_v(base, nums, cats))
    if len(cats) > 1:
        out = out.unionByName(cramers_v(base, list(combinations(cats, 2))))
    return out.withColumn("r", F.coalesce("r", F.lit(0.0)))


def feature_groups(assoc: DataFrame, features: Sequence[str], threshold: float, merge_below: int = 1) -> DataFrame:
    """(feature, group): features linked by |r| >= threshold, named after the first one;
    groups smaller than ``merge_below`` become OTHERS."""
    spark = assoc.sparkSession
    nodes = spark.createDataFrame([(f, f) for f in features], "node string, label string")
    edges = assoc.filter(F.abs("r") >= threshold).select(F.col("f1").alias("src"), F.col("f2").alias("dst"))
    made = connected_components(nodes, edges)
    sizes = made.groupBy("label").agg(F.count(F.lit(1)).alias("_n"))
    return made.join(sizes, "label").select(
        F.col("node").alias("feature"), F.when(F.col("_n") < merge_below, "OTHERS").otherwise(F.col("label")).alias("group"))


def cosine_distances(assoc: DataFrame, features: Sequence[str]) -> DataFrame:
    """(a, b, d) for every two features, a < b: one minus the cosine of their rows in the matrix
    of |r|, which has ones on the diagonal and 0 where no r is known."""
    spark = assoc.sparkSession
    own = spark.createDataFrame([(f, f, 1.0) for f in features], "f string, k string, x double")
    known = assoc.filter(F.col("f1").isin(*features) & F.col("f2").isin(*features) & (F.col("f1") != F.col("f2"))).select(
        "f1", "f2", F.coalesce(F.abs("r"), F.lit(0.0)).alias("x"))
    rows = own.union(known.select("f1", "f2", "x")).union(known.select("f2", "f1", "x"))
    norms = rows.groupBy("f").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("n"))
    a = rows.join(norms, "f").select(F.col("f").alias("a"), "k", (F.col("x") / F.col("n")).alias("xa"))
    b = a.select(F.col("a").alias("b"), "k", F.col("xa").alias("xb"))
    dots = a.join(b, "k").filter(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.sum(F.col("xa") * F.col("xb")).alias("dot"))
    return dots.select("a", "b", (1 - F.col("dot")).alias("d"))


def average_linkage(distances: DataFrame, features: Sequence[str]) -> DataFrame:
    """(a, b, height): the merges of average linkage, each named by a member of either group.

    In a round all groups merge that are each other's nearest one: average linkage is
    reducible, so this gives the merges of the one-by-one procedure in a few rounds. Sums
    of distances between groups add up when groups merge, and the average is the sum over
    the product of the sizes. Of equally near groups the first by name counts."""
    spark = distances.sparkSession
    sizes = written(spark.createDataFrame([(f, 1) for f in features], "g string, n long"))
    sums = written(distances.select("a", "b", F.col("d").alias("s")))
    merges: list[DataFrame] = []
    while not sums.isEmpty():
        na, nb = sizes.toDF("a", "na"), sizes.toDF("b", "nb")
        near = sums.join(na, "a").join(nb, "b").select(F.struct((F.col("s") / (F.col("na") * F.col("nb"))).alias("d"), "a", "b").alias("p"))
        ends = near.select(F.explode(F.array("p.a", "p.b")).alias("g"), "p")
        mutual = ends.groupBy("g").agg(F.min("p").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("both")).filter("both = 2")
        merges.append(written(mutual.select("p.a", "p.b", F.col("p.d").alias("height"))))
        into = merges[-1].select(F.col("b").alias("g"), F.col("a").alias("to"))
        named = sizes.join(into, "g", "left").select(F.coalesce("to", "g").alias("g"), "n")
        sizes = written(named.groupBy("g").agg(F.sum("n").alias("n")))
        moved = sums.join(into.toDF("a", "_a"), "a", "left").join(into.toDF("b", "_b"), "b", "left").select(
            F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"), "s").filter(F.col("a") != F.col("b"))
        sums = written(moved.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("s").alias("s")))
    return reduce(DataFrame.union, merges) if merges else spark.createDataFrame([], "a string, b string, height double")


def linkage_groups(assoc: DataFrame, features: Sequence[str], below: float | None = None, groups: int | None = None) -> DataFrame:
    """(feature, group) by average linkage over cosine distances: groups nearer than ``below``
    merge, or as many merge as leave ``groups`` of them. A group has the name of its first feature."""
    if (below is None) == (groups is None):
        raise ValueError("name either a distance or a number of groups")
    spark = assoc.sparkSession
    merges = average_linkage(cosine_distances(assoc, features), features)
    if groups is None:
        kept = merges.filter(F.col("height") < below)
    else:
        # one row per feature at most
        kept = merges.orderBy("height", "a", "b").limit(max(0, len(features) - max(1, groups)))
    nodes = spark.createDataFrame([(f, f) for f in features], "node string, label string")
    made = connected_components(nodes, kept.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    return made.select(F.col("node").alias("feature"), F.col("label").alias("group"))


def assign_typology(groups: DataFrame, known: DataFrame, assoc: DataFrame) -> DataFrame:
    """(feature, group, typology). Unknown ones take the typology of the group members they
    associate with best on average. A group takes its most frequent typology, unless all its
    typologies are equally frequent: then it is split and each feature keeps its own."""
    both = assoc.select("f1", "f2", "r").union(assoc.select("f2", "f1", "r"))
    typed = groups.join(known, "feature", "left").withColumn("typology", F.coalesce("typology", F.lit(UNKNOWN)))
    others = typed.filter(F.col("typology") != UNKNOWN).select(F.col("feature").alias("f2"), F.col("group").alias("g2"), F.col("typology").alias("t2"))
    guess = (typed.filter(F.col("typology") == UNKNOWN).join(both, F.col("feature") == F.col("f1")).join(others, "f2")
             .filter(F.col("group") == F.col("g2")).groupBy("feature", "t2").agg(F.avg(F.abs("r")).alias("m")))
    best = guess.groupBy("feature").agg(F.min(F.struct((-F.col("m")).alias("m"), F.col("t2").alias("t"))).alias("b"))
    typed = typed.join(best, "feature", "left").select(
        "feature", "group", F.when(F.col("typology") == UNKNOWN, F.coalesce("b.t", F.lit(UNKNOWN))).otherwise(F.col("typology")).alias("typology"))
    counts = typed.groupBy("group", "typology").agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy("group").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min(F.struct((-F.col("n")).alias("n"), F.col("typology").alias("t"))).alias("b"))
    return typed.join(top, "group").select(
        "feature", "group", F.when(F.col("lo") == F.col("hi"), F.col("typology")).otherwise(F.col("b.t")).alias("typology"))


