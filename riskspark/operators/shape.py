"""Table shaping, recoding and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TEXTS = ("None", "null", "NaN", "{}")
# fixed values: reconciliation error codes
ERROR_CODES = {"account": "CDD_ERR_A100", "customer": "CDD_ERR_C100", "transaction": "CDD_ERR_T100",
               "unknown": "CDD_ERR_U100"}


def prune(df: DataFrame, minimal: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    missing = [c for c in minimal if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df.select(*minimal, *[c for c in optional if c in df.columns and c not in minimal])


def select_or_null(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Wanted columns with their types; absent ones become typed nulls."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in cols.items()])


def reshape(df: DataFrame, rename: Mapping[str, str] = {}, fill: Mapping[str, object] = {},
            derive: Mapping[str, str] = {}) -> DataFrame:
    """``rename`` old -> new, ``fill`` new -> constant, ``derive`` new -> existing column to copy."""
    return df.select(
        *[F.col(c).alias(rename.get(c, c)) for c in df.columns],
        *[F.lit(v).alias(n) for n, v in fill.items()],
        *[F.col(c).alias(n) for n, c in derive.items()])


def stamp(df: DataFrame, user: str = "system", at: Column | None = None) -> DataFrame:
    """Creation time, user and the year-month number (year and month written together, unpadded)."""
    now = at if at is not None else F.current_timestamp()
    return df.select("*", now.alias("created_time"), F.lit(user).alias("created_user"),
                     F.concat(F.year(now), F.month(now)).cast("int").alias("year_month"))


def drop_types(df: DataFrame, types: Sequence[str] = ("timestamp", "timestamp_ntz", "date"),
               keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns of the given types unless kept; booleans become 'True' / 'False'."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() in types and f.name not in keep:
            continue
        col = F.col(f.name)
        out.append(F.initcap(col.cast("string")).alias(f.name) if isinstance(f.dataType, T.BooleanType) else col)
    return df.select(*out)


def fill_missing(df: DataFrame, text: str = "MISSING") -> DataFrame:
    """Null numbers become 0, null strings the sentinel."""
    return df.na.fill(0).na.fill(text)


def align(df: DataFrame, trained_cols: Sequence[str]) -> DataFrame:
    """Add columns a trained model expects and the data lacks, as 0.0."""
    return df.select("*", *[F.lit(0.0).alias(c) for c in trained_cols if c not in df.columns])


def clean_nulls(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            col = F.when(~col.isin(*NULL_TEXTS), col)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(f.name))
    return df.select(*out)


def to_ts(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """A date, text or epoch-seconds column as timestamp; other types are refused."""
    kind = df.schema[col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return df
    if isinstance(kind, T.DateType):
        out = F.col(col).cast("timestamp")
    elif isinstance(kind, T.StringType):
        out = F.try_to_timestamp(F.col(col), F.lit(fmt))
    elif isinstance(kind, (T.LongType, T.IntegerType)):
        out = F.timestamp_seconds(F.col(col))
    else:
        raise TypeError(f"column {col} of type {kind.simpleString()} holds no date")
    return df.withColumn(col, out)


def drop_sparse(df: DataFrame, pct: float = 25.0) -> DataFrame:
    """Drop columns with more than ``pct`` percent nulls, zero-fill the numeric rest.

    One aggregate yields all counts; only that single row reaches the driver."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns]).first()
    least = int((100 - pct) / 100 * counts["_rows"] + 1)
    return df.select(*[c for c in df.columns if counts[c] >= least]).na.fill(0)


def recode(col: Column | str, mapping: Mapping[object, Sequence[object]], default: object | None = None) -> Column:
    """``{code: [values]}`` looked up backwards; unmapped -> default (null if none)."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = [F.lit(x) for code, values in mapping.items() for v in values for x in (v, code)]
    out = F.element_at(F.create_map(*pairs), c)
    return out if default is None else F.coalesce(out, F.lit(default))


def labelled_only(df: DataFrame, cols: Sequence[str], mapping: Mapping[object, Sequence[object]]) -> DataFrame:
    known = [v for values in mapping.values() for v in values]
    return df.filter(reduce(lambda a, b: a | b, [F.col(c).isin(*known) for c in cols]))


def require_rows(df: DataFrame, n: int) -> DataFrame:
    """Refuse to go on with fewer than n rows; reads no more than n."""
    found = df.limit(n).count()
    if found < n:
        raise ValueError(f"at least {n} rows are needed, found {found}")
    return df


def reconcile(alerts: DataFrame, parent: DataFrame, key: str, code: str) -> tuple[DataFrame, DataFrame]:
    """Alerts with a parent row, and error rows for those without."""
    keys = parent.select(key).distinct()
    ok = alerts.join(keys, key, "left_semi")
    errors = alerts.join(keys, key, "left_anti").withColumn("error_code", F.lit(ERROR_CODES[code]))
    return ok, errors


def single_hit(df: DataFrame, alert_id: str, entity: tuple[str, str], status: tuple[str, Sequence[str]],
               reason: tuple[str, Sequence[str]]) -> DataFrame:
    """Rows of alerts that have exactly one hit of the entity type in a wanted status,
    and whose reason is a wanted one. Counting is a hash aggregate, not a window, so an
    alert with very many hits is never gathered in one task."""
    wanted = df.filter((F.col(entity[0]) == entity[1]) & F.col(status[0]).isin(*status[1]))
    single = wanted.groupBy(alert_id).count().filter("count = 1").select(alert_id)
    return wanted.join(single, alert_id, "left_semi").filter(F.col(reason[0]).isin(*reason[1]))


def split_activity(df: DataFrame, incoming: str, outgoing: str) -> tuple[DataFrame, DataFrame]:
    """(with activity, without activity) over the look-back sums."""
    active = (F.coalesce(F.col(incoming), F.lit(0)) != 0) | (F.coalesce(F.col(outgoing), F.lit(0)) != 0)
    return df.filter(active), df.filter(~active)


def union_if_same(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union when both hold the same columns, else the first alone."""
    return a.unionByName(b) if set(a.columns) == set(b.columns) else a


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` values per key, by an aggregate with map-side
    combine (a sorted window would gather a hot key in one task)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *[F.col(c) for c in rest])).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])
