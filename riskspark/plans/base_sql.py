"""The logical tables as SQL common table expressions, for the equivalence checks."""

from __future__ import annotations

_CTES: dict[str, str] = {
    "txn": """SELECT l_orderkey AS account, o_custkey AS party, l_suppkey AS opp_party,
        CAST(l_shipdate AS DATE) AS txn_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
        l_returnflag || '-' || l_linestatus AS category,
        CASE l_linestatus WHEN 'O' THEN 'incoming-all' ELSE 'outgoing-all' END AS direction
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "alert": """SELECT o_orderkey AS alert_id, o_custkey AS party, CAST(o_orderdate AS DATE) AS alert_date,
        o_orderstatus AS result FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "hist": """SELECT o_orderkey AS alert_id, o_custkey AS party, CAST(o_orderdate AS DATE) AS alert_date,
        o_orderstatus AS result FROM orders WHERE o_orderpriority = '2-HIGH'""",
    "refs": "SELECT DISTINCT party, alert_date AS ref_date FROM alert",
    "cust": """SELECT c_custkey AS party, c_name AS name, c_mktsegment AS segment,
        CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_nationkey AS nation, n_name AS country,
        n_regionkey AS region_key, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "opp": """SELECT s_suppkey AS opp_party, s_name AS opp_name, s_nationkey AS opp_nation, n_name AS opp_country,
        n_regionkey AS opp_region, CAST(s_acctbal AS DECIMAL(18,2)) AS opp_balance
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "acct": """SELECT o_orderkey AS account, o_custkey AS party, CAST(o_orderdate AS DATE) AS open_date,
        o_orderpriority AS account_type, o_orderstatus AS account_unit, c.closed_date
        FROM orders LEFT JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS closed_date
                               FROM lineitem GROUP BY 1) c ON o_orderkey = l_orderkey""",
    "link": """SELECT o_orderkey AS link_id, o_custkey AS party, o_custkey + 1 + o_orderkey % 3 AS linked_party,
        o_orderpriority AS relation, CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 720 END AS end_date
        FROM orders WHERE o_custkey + 1 + o_orderkey % 3 IN (SELECT c_custkey FROM customer)""",
    "hrp": """SELECT o_custkey AS party, o_orderkey AS interval_id, CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + 365 END AS expiry_date
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    "scored": """SELECT o_orderkey AS id, o_custkey AS party, o_orderpriority AS segment,
        CAST(o_orderdate AS DATE) AS run_date, round(o_totalprice / 600000.0, 4) AS score,
        CASE o_orderstatus WHEN 'F' THEN 1 ELSE 0 END AS label FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "docs": """SELECT doc_id AS id, source, lang, round(n_chars / (n_chars + 1000.0), 6) AS score,
        quality AS label, toxic FROM documents JOIN labels USING (doc_id)""",
}

_NEEDS = {"refs": ["alert"]}


def with_tables(names: str, body: str, **extra: str) -> str:
    """``WITH`` the named logical tables (space separated), then ``extra`` ones, then the query."""
    order: list[str] = []
    for name in names.split():
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in order:
                order.append(needed)
    parts = [f"{n} AS ({_CTES[n]})" for n in order] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body}"      # body may go on with ", more AS (...)"
