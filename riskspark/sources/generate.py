"""Synthetic banking tables. Every value is a hash of (seed, row id, column), so a row
comes out the same wherever and whenever its task runs, and no driver state is needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ALERT_KINDS = ("cdd", "tm", "ns", "case")
#: keys that one task makes rows for, about
ROWS_OF_A_TASK = 10_000
# fixed values: categories; the first three come in, the others go out
INCOMING = ("CDM-cash-deposit", "incoming-cheque", "incoming-fund-transfer")
OUTGOING = ("ATM-withdrawal", "card-payment", "outgoing-fund-transfer")


def draw(seed: int, column: str, *ids: Column | str) -> Column:
    """Uniform number in [0, 1)."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(column), *[(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(float(2 ** 32))


def pick(u: Column, values: Sequence[object], weights: Sequence[float] | None = None) -> Column:
    """The value whose weight interval holds u."""
    weights = list(weights) if weights else [1.0] * len(values)
    total, upto, out = sum(weights), 0.0, F
    for v, w in zip(values[:-1], weights[:-1]):
        upto += w / total
        out = out.when(u < upto, v)
    return out.otherwise(values[-1]) if len(values) > 1 else F.lit(values[0])


def whole(u: Column, low: int, high: int) -> Column:
    """Whole number in [low, high]."""
    return (F.floor(u * (high - low + 1)) + low).cast("bigint")


def marginal(df: DataFrame, name: str, seed: int, ids: Sequence[str], values: Sequence[object], weights: Sequence[float] | None = None) -> DataFrame:
    return df.withColumn(name, pick(draw(seed, name, *ids), values, weights))


def conditional(df: DataFrame, name: str, seed: int, ids: Sequence[str], cases: Sequence[tuple[Column, Sequence[object], Sequence[float]]],
                default: tuple[Sequence[object], Sequence[float]]) -> DataFrame:
    """A column sampled with the weights of the first case that holds."""
    u, out = draw(seed, name, *ids), F
    for cond, values, weights in cases:
        out = out.when(cond, pick(u, values, weights))
    return df.withColumn(name, out.otherwise(pick(u, *default)))


def between_dates(u: Column, start: Column, end: Column) -> Column:
    """Uniform day between two dates, both included."""
    return F.date_add(start, F.floor(u * (F.datediff(end, start) + 1)).cast("int"))


def spread(df: DataFrame, rows: int = ROWS_OF_A_TASK) -> DataFrame:
    """``df`` dealt out to tasks of about ``rows`` rows: keys come from few and small files, and
    without this what is made from them would be made by as few tasks."""
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def party_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("party"))


def customers(parties: DataFrame, seed: int = 1, individuals_per_corporate: float = 9.0) -> DataFrame:
    share = individuals_per_corporate / (individuals_per_corporate + 1)
    date = [F.lit(d).cast("date") for d in ("1926-01-01", "2006-01-01")]
    return parties.select(
        "party", F.when(draw(seed, "type", "party") > share, "C").otherwise("I").alias("party_type"),
        between_dates(draw(seed, "birth", "party"), *date).alias("birth_date"),
        pick(draw(seed, "employment", "party"), ["Worker", "Employee", "Self-employed", "Unemployed"]).alias("employment"),
        pick(draw(seed, "segment", "party"), ["C", "V", "L"]).alias("segment"),
        pick(draw(seed, "risk", "party"), ["0", "1"]).alias("risk_level"))


def accounts(parties: DataFrame, seed: int = 1, most: int = 4) -> DataFrame:
    parties = spread(parties.select("party"))
    n = whole(draw(seed, "accounts", "party"), 1, most)
    rows = parties.select("party", F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("n"))
    return rows.select("party", F.concat_ws("-", F.lit("1"), "party", "n").alias("account"),
                       pick(draw(seed, "currency", "party", "n"), ["SGD", "USD", "EUR"], [6, 3, 1]).alias("currency"))


def party_links(parties: DataFrame, count: int, seed: int = 1, share: float = 0.4, most: int = 3) -> DataFrame:
    """Links of a share of the parties to others, never to themselves."""
    n = F.when(draw(seed, "linked", "party") < share, whole(draw(seed, "links", "party"), 1, most)).otherwise(0).cast("int")
    rows = parties.select("party", F.explode(F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1))))).alias("n"))
    other = whole(draw(seed, "link", "party", "n"), 0, count - 1)
    return rows.select("party", other.alias("linked_party")).filter(F.col("party") != F.col("linked_party")).distinct()


def transactions(accounts_df: DataFrame, seed: int = 1, per_account: int = 12, low: int = 10, high: int = 10000) -> DataFrame:
    rows = accounts_df.select("party", "account", F.explode(F.sequence(F.lit(1), F.lit(per_account))).alias("n"))
    made = rows.select(
        "party", F.concat_ws("-", "account", "n").alias("txn"), "account",
        whole(draw(seed, "amount", "account", "n"), low, high).alias("amount"),
        between_dates(draw(seed, "date", "account", "n"), F.lit("2023-01-01").cast("date"), F.lit("2023-12-31").cast("date")).alias("txn_date"),
        pick(draw(seed, "category", "account", "n"), [*INCOMING, *OUTGOING]).alias("category"))
    return made.withColumn("direction", F.when(F.col("category").isin(*INCOMING), "C").otherwise("D"))


def alerts(parties: DataFrame, seed: int = 1, per_party: int = 2) -> DataFrame:
    """``per_party`` alerts of each kind: created and closed dates, result and analyst."""
    rows = parties.select("party", F.explode(F.sequence(F.lit(1), F.lit(per_party))).alias("n"))
    out = None
    for kind in ALERT_KINDS:
        created = between_dates(draw(seed, f"{kind}-created", "party", "n"), F.lit("2024-01-01").cast("date"), F.lit("2024-01-20").cast("date"))
        made = rows.select(
            F.concat_ws("-", F.lit("1"), F.lit(f"{kind}-alert"), "party", "n").alias("alert"), "party", F.lit(kind).alias("kind"),
            created.alias("created"), F.date_add(created, whole(draw(seed, f"{kind}-open", "party", "n"), 1, 10).cast("int")).alias("closed"),
            pick(draw(seed, f"{kind}-result", "party", "n"), ["Non-STR", "STR"], [9, 1]).alias("result"),
            pick(draw(seed, f"{kind}-analyst", "party", "n"), ["analyst-1", "analyst-2", "analyst-3"]).alias("analyst"))
        out = made if out is None else out.unionByName(made)
    return out
