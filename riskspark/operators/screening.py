"""Watch-list screening: pairs of alerted customers and list entries, and their features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import names as nm

YEAR_DAYS = 365.25


def screen_merge(alerts: DataFrame, watchlist: DataFrame, customers: DataFrame, list_key: str = "watchlist_id",
                 party_key: str = "party") -> DataFrame:
    """Alerts with their list entry and customer; keys are compared as text."""
    def as_text(df: DataFrame, key: str) -> DataFrame:
        return df.withColumn(key, F.trim(F.col(key).cast("string")))
    return as_text(as_text(alerts, list_key), party_key).join(as_text(watchlist, list_key), list_key).join(as_text(customers, party_key), party_key)


def block_join(left: DataFrame, right: DataFrame, left_name: str, right_name: str, threshold: float) -> DataFrame:
    """All pairs of distinct names whose word sets have a Jaccard similarity of at least
    ``threshold`` - exactly, without comparing everything.

    Two such sets must share one of their rarest words: with words ordered from rare to
    frequent, the first ``n - ceil(threshold * n) + 1`` of each set have to meet. Pairs are
    made on those words only, so a word in a third of all names joins just the few names
    that hold nothing rarer. Names are distinct before, so copies do not multiply.
    """
    def sets(df: DataFrame, col: str, side: str) -> DataFrame:
        words = F.array_distinct(nm.tokens(F.col(f"{side}_name")))
        return df.filter(F.col(col).isNotNull()).select(F.col(col).alias(f"{side}_name")).distinct().select(
            f"{side}_name", words.alias(f"{side}_words")).filter(F.size(f"{side}_words") > 0)

    a, b = sets(left, left_name, "l"), sets(right, right_name, "r")
    both = a.select(F.explode("l_words").alias("word")).union(b.select(F.explode("r_words").alias("word")))
    use = both.groupBy("word").agg(F.count(F.lit(1)).alias("use"))

    def prefixes(df: DataFrame, side: str) -> DataFrame:
        long = df.select(f"{side}_name", f"{side}_words", F.explode(f"{side}_words").alias("word")).join(use, "word")
        ranked = long.groupBy(f"{side}_name", f"{side}_words").agg(F.array_sort(F.collect_list(F.struct("use", "word"))).alias("_o"))
        n = F.size(f"{side}_words")
        keep = n - F.ceil(F.lit(threshold) * n - 1e-9).cast("int") + 1
        return ranked.select(f"{side}_name", f"{side}_words", F.explode(F.slice("_o", F.lit(1), keep)).alias("_w")).select(
            f"{side}_name", f"{side}_words", F.col("_w.word").alias("word"))

    nl, nr = F.size("l_words"), F.size("r_words")
    pairs = prefixes(a, "l").join(prefixes(b, "r"), "word").filter(
        (nl >= F.lit(threshold) * nr - 1e-9) & (nr >= F.lit(threshold) * nl - 1e-9)).drop("word").distinct()
    shared = F.size(F.array_intersect("l_words", "r_words"))
    similarity = shared / (nl + nr - shared)
    return pairs.withColumn("similarity", similarity).filter(F.col("similarity") >= threshold - 1e-9).select("l_name", "r_name", "similarity")


def edit_join(left: DataFrame, right: DataFrame, left_name: str, right_name: str, ratio: float, spare: int = 2) -> DataFrame:
    """(l_name, r_name, similarity): all pairs of distinct names whose ``edit_ratio`` is at least
    ``ratio`` (above a half) - exactly, without comparing everything.

    Two names of given lengths may be t edits apart. If the right one is cut into
    t + 1 + ``spare`` pieces, at least ``spare`` + 1 of them stand unchanged in the left one, each at
    most so far from its place that the shifts before and behind it add up to t or less. So of the
    pieces of every right name, the ``spare`` most frequent ones ("LIMITED") need not be
    looked up, and a left name meets just those that share one of the others. Null and
    empty names are left out; copies do not multiply.
    """
    if not 0.5 < ratio <= 1:
        raise ValueError("the ratio must be above 0.5 and at most 1")

    def names(df: DataFrame, col: str, side: str) -> DataFrame:
        return df.select(F.col(col).alias(f"{side}_name")).filter(F.length(f"{side}_name") > 0).distinct().withColumn(f"_{side}", F.length(f"{side}_name"))

    def lengths(length: str) -> Column:
        return F.explode(F.sequence(F.greatest(F.lit(1), F.ceil(F.col(length) * ratio - 1e-9)).cast("int"), F.floor(F.col(length) / ratio + 1e-9).cast("int")))

    edits = F.floor((1 - ratio) * F.greatest("_l", "_r") + 1e-9).cast("int")
    count = F.col("_t") + 1 + spare
    start, end = F.floor(F.col("_i") * F.col("_r") / count).cast("int"), F.floor((F.col("_i") + 1) * F.col("_r") / count).cast("int")
    numbers = F.explode(F.sequence(F.lit(0), F.col("_t") + spare))

    # one set of pieces for each number of edits that some length of the other name allows
    pieces = names(right, right_name, "r").withColumn("_l", lengths("_r")).select("r_name", "_r", edits.alias("_t")).distinct().withColumn("_i", numbers).select(
        "r_name", "_r", "_t", F.xxhash64("_r", "_t", "_i", F.substring("r_name", start + 1, end - start)).alias("_key"))
    use = pieces.groupBy("_key").agg(F.count(F.lit(1)).alias("_use"))
    index = pieces.join(use, "_key").groupBy("r_name", "_r", "_t").agg(F.collect_list(F.struct("_use", "_key")).alias("_all")).select(
        "r_name", F.explode(F.slice(F.array_sort("_all"), F.lit(1), F.col("_t") + 1)).alias("_k")).select("r_name", F.col("_k._key").alias("_key"))

    longer = F.col("_l") - F.col("_r")
    low = F.greatest(F.lit(0), start - F.floor((F.col("_t") - longer) / 2).cast("int"))
    high = F.least(F.col("_l") - (end - start), start + F.floor((F.col("_t") + longer) / 2).cast("int"))
    places = F.explode(F.when(low <= high, F.sequence(low, F.greatest(low, high))))
    asked = names(left, left_name, "l").withColumn("_r", lengths("_l")).withColumn("_t", edits).withColumn("_i", numbers).withColumn("_at", places).select(
        "l_name", F.xxhash64("_r", "_t", "_i", F.substring("l_name", F.col("_at") + 1, end - start)).alias("_key"))
    similarity = nm.edit_ratio(F.col("l_name"), F.col("r_name"))
    return asked.join(index, "_key").filter(similarity >= ratio - 1e-9).select("l_name", "r_name").distinct().withColumn("similarity", similarity)


def match_flag(a: Column, b: Column, unknown: Sequence[str] = ()) -> Column:
    """1 / 0 for equal / different texts, null when one is missing or unknown."""
    x, y = F.upper(F.trim(a)), F.upper(F.trim(b))
    known = x.isNotNull() & y.isNotNull()
    if unknown:
        known = known & ~x.isin(*unknown) & ~y.isin(*unknown)
    return F.when(known, F.when(x == y, 1).otherwise(0))


def age_at(birth: Column, at: Column) -> Column:
    return (F.datediff(at, birth) / YEAR_DAYS).cast("int")


def list_age(age: Column, age_of: Column, birth: Column, at: Column) -> Column:
    """Age of a list entry: from the birth date, else the recorded age carried forward."""
    return F.coalesce(age_at(birth, at), age + (F.datediff(at, age_of) / YEAR_DAYS).cast("int"))


def first_char(name: Column) -> Column:
    return F.substring(F.regexp_replace(F.upper(name), r"[^0-9A-Z]", ""), 1, 1)


def keyword_match(a: Column, b: Column, keywords: Sequence[str]) -> Column:
    """1 when both texts hold the same keyword."""
    shared = F.array_intersect(nm.tokens(nm.normalise(a)), nm.tokens(nm.normalise(b)))
    return F.when(F.arrays_overlap(shared, F.array(*[F.lit(k) for k in keywords])), 1).otherwise(0)


def year_in(text: Column) -> Column:
    """First plausible year in a text."""
    year = F.regexp_extract(text, r"\b(1[89]\d\d|20\d\d)\b", 1)
    return F.when(year != "", year.cast("int"))


def best_party_match(name: Column, country: Column, parties: Column, countries: Column) -> tuple[Column, Column]:
    """Best ratio of a name to a ``;`` list of trading partners, and whether the country is listed."""
    scores = F.transform(F.split(parties, ";"), lambda p: nm.edit_ratio(nm.normalise(p), name))
    listed = F.array_contains(F.transform(F.split(countries, ";"), lambda c: F.upper(F.trim(c))), F.upper(country))
    return F.array_max(scores), F.when(listed, 1).otherwise(0)


def related_name_scores(pairs: DataFrame, related: DataFrame, listed: DataFrame) -> DataFrame:
    """Best ratio between names related to the customer and names linked on the list, for
    kin and other relations.

    ``pairs`` (party, watchlist_id), ``related`` (party, kin, related_name), ``listed``
    (watchlist_id, linked_name). Names are distinct per key; each pair of names is scored
    once and joined back, and the maximum combines before the shuffle."""
    who = pairs.select("party", "watchlist_id").distinct()
    combos = who.join(related.distinct(), "party").join(listed.distinct(), "watchlist_id")
    scored = combos.select("related_name", "linked_name").distinct().withColumn(
        "score", F.greatest(nm.edit_ratio(F.col("related_name"), F.col("linked_name")),
                            nm.token_sort_ratio(F.col("related_name"), F.col("linked_name"))))
    best = combos.join(scored, ["related_name", "linked_name"]).groupBy("party", "watchlist_id").agg(
        F.max(F.when(F.col("kin"), F.col("score"))).alias("kin_score"), F.max(F.when(~F.col("kin"), F.col("score"))).alias("other_score"))
    return who.join(best, ["party", "watchlist_id"], "left")


def synonym_score(pairs: DataFrame, synonyms: DataFrame, a: str, b: str, keys: Sequence[str]) -> DataFrame:
    """0, 1 or 2: a word of one name has a synonym in the other, counted per direction."""
    out = pairs.select(*keys, a, b).distinct()
    for i, (src, dst) in enumerate(((a, b), (b, a))):
        hits = (out.select(*keys, F.explode(F.array_distinct(nm.tokens(F.col(src)))).alias("word"), nm.tokens(F.col(dst)).alias("_other"))
                .join(synonyms, "word").filter(F.array_contains("_other", F.col("synonym"))).select(*keys).distinct().withColumn(f"_h{i}", F.lit(1)))
        out = out.join(hits, list(keys), "left")
    return out.select(*keys, (F.coalesce("_h0", F.lit(0)) + F.coalesce("_h1", F.lit(0))).alias("synonym_score"))
