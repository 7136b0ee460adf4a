"""Queries over name screening: pairs of alerted customers and watch-list entries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import names as nm
from riskspark.operators import screening as sc
from riskspark.plans.registry import query
from riskspark.sources import tables as t

AT = "2024-01-31"

# customers and list entries carry a product-like name, the entries as "TYPE, name"
PAIR_SQL = """WITH cn AS (SELECT c_custkey AS party, p_name || ' ' || c_mktsegment AS raw_name, c_nationkey AS nation FROM customer JOIN part ON p_partkey = c_custkey),
    wl AS (SELECT s_suppkey AS watchlist_id, p_type || ', ' || p_name AS list_raw, p_name || ';' || s_name || ';' || p_type || ',' || p_name AS aliases, p_name, s_nationkey AS list_nation, p_partkey FROM supplier JOIN part ON p_partkey = s_suppkey),
    hit AS (SELECT DISTINCT l_orderkey AS alert_id, o_custkey AS party, l_suppkey AS watchlist_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'),
    merged AS (SELECT alert_id, CAST(party AS VARCHAR) AS party, CAST(watchlist_id AS VARCHAR) AS watchlist_id, raw_name, list_raw, aliases, nation, list_nation FROM hit JOIN wl USING (watchlist_id) JOIN cn USING (party)),
    pair AS (SELECT *, trim(regexp_replace(upper(raw_name), '[^0-9A-Z]+', ' ', 'g')) AS name,
        trim(regexp_replace(upper(trim(split_part(list_raw, ',', 2)) || ' ' || trim(split_part(list_raw, ',', 1))), '[^0-9A-Z]+', ' ', 'g')) AS list_name FROM merged)"""


def named_customers(spark, sf):
    part = t.load(spark, sf, "part").select("p_partkey", "p_name")
    return t.load(spark, sf, "customer").join(part, F.col("p_partkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("party"), F.concat_ws(" ", "p_name", "c_mktsegment").alias("raw_name"), F.col("c_nationkey").alias("nation"))


def watchlist(spark, sf):
    part = t.load(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return t.load(spark, sf, "supplier").join(part, F.col("p_partkey") == F.col("s_suppkey")).select(
        F.col("s_suppkey").alias("watchlist_id"), F.concat(F.col("p_type"), F.lit(", "), F.col("p_name")).alias("list_raw"),
        F.concat(F.col("p_name"), F.lit(";"), F.col("s_name"), F.lit(";"), F.col("p_type"), F.lit(","), F.col("p_name")).alias("aliases"),
        "p_name", F.col("s_nationkey").alias("list_nation"), F.col("s_name").alias("entry_code"))


def hits(spark, sf):
    urgent = t.alerts(spark, sf).select("alert_id", "party")
    items = t.load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("alert_id"), F.col("l_suppkey").alias("watchlist_id"))
    return items.join(urgent, "alert_id").distinct()


def merged(spark, sf):
    return sc.screen_merge(hits(spark, sf), watchlist(spark, sf), named_customers(spark, sf))


def pairs(spark, sf):
    return merged(spark, sf).withColumn("name", nm.normalise(F.col("raw_name"))).withColumn(
        "list_name", nm.normalise(nm.comma_flip(F.col("list_raw"))))


KEYS = ["alert_id", "watchlist_id"]


def scored(spark, sf, **cols):
    return pairs(spark, sf).select(*KEYS, *[c.alias(n) for n, c in cols.items()])


def pair_sql(**cols: str) -> str:
    return PAIR_SQL + " SELECT alert_id, watchlist_id, " + ", ".join(f"{e} AS {n}" for n, e in cols.items()) + " FROM pair"


@query("screen_merge", PAIR_SQL + " SELECT alert_id, party, watchlist_id, raw_name, list_raw FROM merged")
def screen_merge(spark, sf):
    return merged(spark, sf).select("alert_id", "party", "watchlist_id", "raw_name", "list_raw")


@query("name_normalise", pair_sql(name="name"))
def name_normalise(spark, sf):
    return scored(spark, sf, name=F.col("name"))


@query("name_comma_flip", pair_sql(flipped="trim(split_part(list_raw, ',', 2)) || ' ' || trim(split_part(list_raw, ',', 1))"))
def name_comma_flip(spark, sf):
    return scored(spark, sf, flipped=nm.comma_flip(F.col("list_raw")))


WORDS = "string_split({c}, ' ')"


@query("name_token_count", pair_sql(name_tokens=f"CAST(len({WORDS.format(c='name')}) AS INT)", list_tokens=f"CAST(len({WORDS.format(c='list_name')}) AS INT)"))
def name_token_count(spark, sf):
    return scored(spark, sf, name_tokens=nm.token_count(F.col("name")), list_tokens=nm.token_count(F.col("list_name")))


@query("name_token_overlap", pair_sql(overlap=f"CAST(len(list_filter({WORDS.format(c='list_name')}, lambda x: list_contains({WORDS.format(c='name')}, x))) AS INT)"))
def name_token_overlap(spark, sf):
    return scored(spark, sf, overlap=nm.token_overlap(F.col("list_name"), F.col("name")))


def gram_sql(n: int) -> str:
    def g(c: str) -> str:
        return f"list_transform(range(1, len({c}) - {n} + 2), lambda i: substr({c}, i, {n}))"
    return f"ROUND(len(list_filter({g('list_name')}, lambda x: list_contains({g('name')}, x))) / GREATEST(len({g('list_name')}), len({g('name')}))::DOUBLE, 6)"


def _gram_query(n: int):
    @query(f"name_ngram_{n}", pair_sql(score=gram_sql(n)))
    def run(spark, sf):
        return scored(spark, sf, score=F.round(nm.ngram_score(F.col("list_name"), F.col("name"), n), 6))
    return run


for _n in (1, 2, 3):
    _gram_query(_n)

EDIT = "(1 - levenshtein({a}, {b}) / GREATEST(length({a}), length({b}))::DOUBLE)"
SORTED = "array_to_string(list_sort(string_split(trim(regexp_replace(lower({c}), '[^0-9a-z]+', ' ', 'g')), ' ')), ' ')"


@query("name_edit_ratio", pair_sql(score="ROUND(" + EDIT.format(a="list_name", b="name") + ", 6)"))
def name_edit_ratio(spark, sf):
    return scored(spark, sf, score=F.round(nm.edit_ratio(F.col("list_name"), F.col("name")), 6))


@query("name_token_sort_ratio", pair_sql(score="ROUND(" + EDIT.format(a=SORTED.format(c="list_name"), b=SORTED.format(c="name")) + ", 6)"))
def name_token_sort_ratio(spark, sf):
    return scored(spark, sf, score=F.round(nm.token_sort_ratio(F.col("list_name"), F.col("name")), 6))


@query("name_subset_ratio", pair_sql(score="""ROUND(list_max(list_transform(range(1, length(name) + 1), lambda i: list_max(list_transform(range(0, length(name) - i + 2),
    lambda k: CASE WHEN contains(list_name, substr(name, i, k)) THEN k ELSE 0 END)))) / GREATEST(length(name), length(list_name))::DOUBLE, 6)"""))
def name_subset_ratio(spark, sf):
    return scored(spark, sf, score=F.round(nm.subset_ratio(F.col("name"), F.col("list_name")), 6))


FLIP = "CASE WHEN contains(x, ',') THEN trim(split_part(x, ',', 2)) || ' ' || trim(split_part(x, ',', 1)) ELSE x END"


@query("name_alias_best", PAIR_SQL + f", ex AS (SELECT alert_id, watchlist_id, raw_name, UNNEST(string_split(aliases, ';')) AS x FROM pair), f AS (SELECT alert_id, watchlist_id, raw_name AS n, {FLIP} AS a FROM ex) SELECT alert_id, watchlist_id, ROUND(MAX(GREATEST({EDIT.format(a='a', b='n')}, {EDIT.format(a=SORTED.format(c='a'), b=SORTED.format(c='n'))})), 6) AS score FROM f GROUP BY 1, 2")
def name_alias_best(spark, sf):
    return scored(spark, sf, score=F.round(nm.alias_best(F.col("raw_name"), F.col("aliases")), 6))


@query("name_block_join", PAIR_SQL + """, a AS (SELECT DISTINCT trim(regexp_replace(upper(raw_name), '[^0-9A-Z]+', ' ', 'g')) AS l_name FROM cn),
    b AS (SELECT DISTINCT trim(regexp_replace(upper(trim(split_part(list_raw, ',', 2)) || ' ' || trim(split_part(list_raw, ',', 1))), '[^0-9A-Z]+', ' ', 'g')) AS r_name FROM wl),
    s AS (SELECT l_name, r_name, list_distinct(string_split(l_name, ' ')) AS lw, list_distinct(string_split(r_name, ' ')) AS rw FROM a, b),
    j AS (SELECT l_name, r_name, len(list_intersect(lw, rw)) AS k, len(lw) AS nl, len(rw) AS nr FROM s)
    SELECT l_name, r_name, ROUND(k / (nl + nr - k)::DOUBLE, 6) AS similarity FROM j WHERE k / (nl + nr - k)::DOUBLE >= 0.5 - 1e-9""")
def name_block_join(spark, sf):
    left = named_customers(spark, sf).withColumn("n", nm.normalise(F.col("raw_name")))
    right = watchlist(spark, sf).withColumn("n", nm.normalise(nm.comma_flip(F.col("list_raw"))))
    made = sc.block_join(left, right, "n", "n", 0.5)
    return made.select("l_name", "r_name", F.round("similarity", 6).alias("similarity"))


@query("name_edit_join", f"""WITH a AS (SELECT DISTINCT upper(p_name || ' ' || n_name) AS l_name FROM customer JOIN part ON p_partkey = c_custkey JOIN nation ON n_nationkey = c_nationkey),
    b AS (SELECT DISTINCT upper(p_name || ' ' || n_name) AS r_name FROM supplier JOIN part ON p_partkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey),
    m AS (SELECT l_name, r_name, {EDIT.format(a='l_name', b='r_name')} AS s FROM a, b) SELECT l_name, r_name, ROUND(s, 6) AS similarity FROM m WHERE s >= 0.8 - 1e-9""")
def name_edit_join(spark, sf):
    """Customers and list entries whose names with their country are nearly equal."""
    nation = t.load(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    part = t.load(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_name")

    def full(table, key, nation_key):
        rows = t.load(spark, sf, table).select(F.col(key).alias("k"), F.col(nation_key).alias("nation"))
        return rows.join(part, "k").join(nation, "nation").select(F.upper(F.concat_ws(" ", "p_name", "n_name")).alias("full_name"))

    made = sc.edit_join(full("customer", "c_custkey", "c_nationkey"), full("supplier", "s_suppkey", "s_nationkey"), "full_name", "full_name", 0.8)
    return made.select("l_name", "r_name", F.round("similarity", 6).alias("similarity"))


DEMO_SQL = PAIR_SQL + """, d AS (SELECT alert_id, watchlist_id, CASE WHEN CAST(party AS BIGINT) % 2 = 0 THEN 'M' ELSE 'F' END AS g1, (['m', 'F', 'U'])[CAST(CAST(watchlist_id AS BIGINT) % 3 + 1 AS INT)] AS g2, nation, list_nation, nation % 5 AS r1, list_nation % 5 AS r2,
    CAST(trunc(date_diff('day', DATE '1940-01-01' + CAST(CAST(party AS BIGINT) * 17 % 25000 AS INT), DATE '2024-01-31') / 365.25) AS INT) AS customer_age,
    COALESCE(CASE WHEN CAST(watchlist_id AS BIGINT) % 4 <> 0 THEN CAST(trunc(date_diff('day', DATE '1940-01-01' + CAST(CAST(watchlist_id AS BIGINT) * 31 % 25000 AS INT), DATE '2024-01-31') / 365.25) AS INT) END,
        40 + CAST(trunc(date_diff('day', DATE '2010-06-01', DATE '2024-01-31') / 365.25) AS INT)) AS list_age, CAST(18 + CAST(watchlist_id AS BIGINT) % 50 AS INT) AS min_age FROM pair)"""


@query("screen_demographics", DEMO_SQL + """ SELECT alert_id, watchlist_id, CAST(CASE WHEN g2 = 'U' THEN NULL WHEN g1 = upper(g2) THEN 1 ELSE 0 END AS INT) AS gender_match, CAST(nation = list_nation AS INT) AS nationality_match,
    CAST(r1 = r2 AS INT) AS birth_country_match, customer_age, list_age, CAST(ABS(customer_age - list_age) AS INT) AS age_difference, CAST(customer_age >= min_age AS INT) AS above_min_age FROM d""")
def screen_demographics(spark, sf):
    df, at = pairs(spark, sf), F.lit(AT).cast("date")
    party, entry = F.col("party").cast("bigint"), F.col("watchlist_id").cast("bigint")
    base = F.lit("1940-01-01").cast("date")
    age = sc.age_at(F.date_add(base, (party * 17 % 25000).cast("int")), at)
    birth = F.when(entry % 4 != 0, F.date_add(base, (entry * 31 % 25000).cast("int")))
    their = sc.list_age(F.lit(40), F.lit("2010-06-01").cast("date"), birth, at)
    gender = F.when(party % 2 == 0, "M").otherwise("F")
    listed = F.element_at(F.array(F.lit("m"), F.lit("F"), F.lit("U")), (entry % 3 + 1).cast("int"))
    return df.select(
        *KEYS, sc.match_flag(gender, listed, ["U"]).alias("gender_match"),
        sc.match_flag(F.col("nation").cast("string"), F.col("list_nation").cast("string")).alias("nationality_match"),
        sc.match_flag((F.col("nation") % 5).cast("string"), (F.col("list_nation") % 5).cast("string")).alias("birth_country_match"),
        age.alias("customer_age"), their.alias("list_age"), F.abs(age - their).alias("age_difference"),
        F.when(age >= (18 + entry % 50).cast("int"), 1).otherwise(0).alias("above_min_age"))


KEYWORDS = ["RING", "WIDGET", "STEEL", "BOLT", "ECONOMY", "STANDARD"]
_KW = " OR ".join(f"(list_contains(string_split(name, ' '), '{k}') AND list_contains(string_split(list_name, ' '), '{k}'))" for k in KEYWORDS)
CORP_SQL = PAIR_SQL + ", c AS (SELECT *, 'founded in ' || (1900 + CAST(watchlist_id AS BIGINT) % 120) || ' as trader' AS info, CAST(1900 + CAST(party AS BIGINT) % 120 AS INT) AS own_year, list_name || ' ;' || raw_name AS partners, 'N' || list_nation || '; N' || (list_nation + 1) AS partner_countries FROM pair)"


@query("screen_corporate", CORP_SQL + f""" SELECT alert_id, watchlist_id, CAST(substr(name, 1, 1) = substr(list_name, 1, 1) AS INT) AS first_char_match, CAST(contains(name, substr(list_name, 1, 1)) AS INT) AS first_char_in_name,
    CAST(ABS(CAST(regexp_extract(info, '(1[89][0-9][0-9]|20[0-9][0-9])') AS INT) - own_year) AS INT) AS year_difference, CAST(({_KW}) AS INT) AS keyword_match, CAST(nation = list_nation AS INT) AS country_match,
    ROUND(GREATEST({EDIT.format(a='list_name', b='name')}, 1.0::DOUBLE), 6) AS partner_name_score, CAST(nation IN (list_nation, list_nation + 1) AS INT) AS partner_country_match FROM c""")
def screen_corporate(spark, sf):
    df = pairs(spark, sf)
    entry, party = F.col("watchlist_id").cast("bigint"), F.col("party").cast("bigint")
    info = F.concat(F.lit("founded in "), (1900 + entry % 120).cast("string"), F.lit(" as trader"))
    partners = F.concat(F.col("list_name"), F.lit(" ;"), F.col("raw_name"))
    countries = F.concat(F.lit("N"), F.col("list_nation").cast("string"), F.lit("; N"), (F.col("list_nation") + 1).cast("string"))
    score, listed = sc.best_party_match(F.col("name"), F.concat(F.lit("n"), F.col("nation").cast("string")), partners, countries)
    first = sc.first_char(F.col("list_name"))
    return df.select(
        *KEYS, F.when(sc.first_char(F.col("name")) == first, 1).otherwise(0).alias("first_char_match"),
        F.when(F.col("name").contains(first), 1).otherwise(0).alias("first_char_in_name"),
        F.abs(sc.year_in(info) - (1900 + party % 120).cast("int")).alias("year_difference"),
        sc.keyword_match(F.col("name"), F.col("list_name"), KEYWORDS).alias("keyword_match"),
        sc.match_flag(F.col("nation").cast("string"), F.col("list_nation").cast("string")).alias("country_match"),
        F.round(score, 6).alias("partner_name_score"), listed.alias("partner_country_match"))


@query("screen_industry", PAIR_SQL + """, dict AS (SELECT lower(p_name) AS company, MIN(p_brand) AS industry FROM part WHERE p_size < 25 GROUP BY 1)
    SELECT watchlist_id, industry FROM wl LEFT JOIN dict ON company = lower(p_name)""")
def screen_industry(spark, sf):
    """Industry from a company dictionary kept as a table."""
    dictionary = t.load(spark, sf, "part").filter("p_size < 25").groupBy(F.lower("p_name").alias("company")).agg(F.min("p_brand").alias("industry"))
    return watchlist(spark, sf).withColumn("company", F.lower("p_name")).join(dictionary, "company", "left").select("watchlist_id", "industry")


@query("screen_related_names", PAIR_SQL + f""", who AS (SELECT DISTINCT party, watchlist_id FROM hit),
    rel AS (SELECT DISTINCT o_custkey AS party, o_orderpriority IN ('1-URGENT', '2-HIGH') AS kin, upper(raw_name) AS rn FROM orders JOIN cn ON cn.party = o_custkey + 1 + o_orderkey % 3),
    lk AS (SELECT DISTINCT a.watchlist_id, upper(b.p_name) AS ln FROM wl a JOIN wl b ON b.watchlist_id IN (a.watchlist_id + 1, a.watchlist_id + 2)),
    s AS (SELECT who.party, who.watchlist_id, kin, GREATEST({EDIT.format(a='rn', b='ln')}, {EDIT.format(a=SORTED.format(c='rn'), b=SORTED.format(c='ln'))}) AS score FROM who JOIN rel USING (party) JOIN lk USING (watchlist_id))
    SELECT who.party, who.watchlist_id, ROUND(MAX(CASE WHEN kin THEN score END), 6) AS kin_score, ROUND(MAX(CASE WHEN NOT kin THEN score END), 6) AS other_score FROM who LEFT JOIN s USING (party, watchlist_id) GROUP BY 1, 2""")
def screen_related_names(spark, sf):
    names = named_customers(spark, sf).select(F.col("party").alias("linked_party"), F.upper("raw_name").alias("related_name"))
    related = t.links(spark, sf).join(names, "linked_party").select(
        "party", F.col("relation").isin("1-URGENT", "2-HIGH").alias("kin"), "related_name")
    entries = watchlist(spark, sf).withColumn("linked_to", F.concat_ws(";", F.col("watchlist_id") + 1, F.col("watchlist_id") + 2))
    linked = entries.select("watchlist_id", F.explode(F.split("linked_to", ";")).alias("other")).withColumn("other", F.col("other").cast("bigint")).join(
        watchlist(spark, sf).select(F.col("watchlist_id").alias("other"), F.upper("p_name").alias("linked_name")), "other").select("watchlist_id", "linked_name")
    made = sc.related_name_scores(hits(spark, sf), related, linked)
    return made.select("party", "watchlist_id", F.round("kin_score", 6).alias("kin_score"), F.round("other_score", 6).alias("other_score"))


@query("screen_synonyms", PAIR_SQL + """, syn AS (SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS word, upper(split_part(p_name, ' ', 2)) AS synonym FROM part),
    p AS (SELECT DISTINCT alert_id, watchlist_id, name, list_name FROM pair),
    s AS (SELECT p.*, EXISTS (SELECT 1 FROM syn WHERE list_contains(string_split(p.list_name, ' '), word) AND list_contains(string_split(p.name, ' '), synonym)) AS a,
        EXISTS (SELECT 1 FROM syn WHERE list_contains(string_split(p.name, ' '), word) AND list_contains(string_split(p.list_name, ' '), synonym)) AS b FROM p)
    SELECT alert_id, watchlist_id, CAST(a AS INT) + CAST(b AS INT) AS synonym_score FROM s""")
def screen_synonyms(spark, sf):
    dictionary = t.load(spark, sf, "part").groupBy(F.upper(F.split("p_name", " ")[0]).alias("word")).agg(
        F.array_join(F.collect_set(F.upper(F.split("p_name", " ")[1])), ";").alias("synonyms"))
    rows = dictionary.select("word", F.explode(F.split("synonyms", ";")).alias("synonym"))
    return sc.synonym_score(pairs(spark, sf), rows, "list_name", "name", KEYS)


@query("screen_unique_names", PAIR_SQL + " SELECT watchlist_id, CASE WHEN p_name = list_raw THEN p_name ELSE p_name || ';' || list_raw END AS names FROM wl")
def screen_unique_names(spark, sf):
    listed = F.concat(F.col("p_name"), F.lit("; "), F.col("list_raw"), F.lit(";;"), F.col("p_name"), F.lit(" ;"), F.col("list_raw"))
    return watchlist(spark, sf).select("watchlist_id", nm.unique_names(listed).alias("names"))
