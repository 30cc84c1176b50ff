"""Queries over grouping and order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.grouping import KEY, group_agg, group_apply, group_fields, group_frames, with_group_key
from sluice.operators.ordering import groups_in_key_order, with_ordinals
from sluice.operators.segments import GroupScan, group_scan
from sluice.plans.stages import Stage, run_stages
from sluice.queries.common import Query, row_count, table, total_cents, whole_number


def group_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    quantity = F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    return group_fields(lines, ["l_returnflag", "l_linestatus", "l_linenumber"], row_count(), quantity)


def group_key_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with nested fields and fields that are not always there."""
    k = F.from_json("props", "k int")
    events = table(spark, sf_dir, "events").select("event_type", F.when(k["k"] > 50, k).alias("props"), "value")
    cents = F.sum(whole_number(F.col("value"))).alias("cents")
    return group_fields(events, ["props.k", "event_type"], row_count(), cents)


def group_key_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third or more of the records have no field of the key and share one group."""
    k = F.from_json("props", "k int")
    events = table(spark, sf_dir, "events").select(F.when(k["k"] > 50, k).alias("props"))
    return group_agg(with_group_key(events, ["props.k"]), row_count())


def group_key_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, decimal, text, null and absent fields make different keys."""
    k = F.get_json_object("props", "$.k")
    spelled = (
        F.when(F.col("event_type") == "click", F.concat(F.lit('"k":'), k))
        .when(F.col("event_type") == "view", F.concat(F.lit('"k" : '), k, F.lit(".00")))
        .when(F.col("event_type") == "error", F.concat(F.lit('"k":"'), k, F.lit('"')))
        .when(F.col("event_type") == "signup", '"k":null')
        .otherwise("")
    )
    record = F.concat(F.lit('{"props":{'), spelled, F.lit("}}"))
    events = table(spark, sf_dir, "events").select(record.alias("json"))
    return group_agg(with_group_key(events, ["props.k", "none"], json="json"), row_count())


def explicit_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage sets the key of some records; the grouping fields give the others'."""
    key = F.when(F.col("o_totalprice") >= 400000, '{"size":"large"}')
    stages = [
        Stage("set_key", lambda df: df.withColumn("set_key", key)),
        Stage("count", aggregates=lambda: [row_count()], grouping_fields=("o_orderstatus",), given_key="set_key"),
    ]
    return run_stages(table(spark, sf_dir, "orders"), stages)


def _user_totals(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.groupby(KEY, as_index=False, sort=False).agg({"n": "sum", "cents": "sum", "top": "max"})


def _user_rows(key: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A total for each user, and a second row for those with a high value."""
    n = cents = top = 0
    for rows in batches:
        n, cents, top = n + rows["n"].sum(), cents + rows["cents"].sum(), max(top, rows["top"].max())
    found = {"total": cents} if top <= 20000 else {"total": cents, "top": top}
    yield pd.DataFrame({"kind": list(found), "n": n, "amount": list(found.values())})


def _user_frames(rows: pd.DataFrame) -> pd.DataFrame:
    """The same for many users at once."""
    totals = _user_totals(rows)
    high = totals[totals["top"] > 20000]
    found = pd.concat([totals.assign(kind="total", amount=totals["cents"]), high.assign(kind="top", amount=high["top"])])
    return found[[KEY, "kind", "n", "amount"]]


USER_SCHEMA = f"{KEY} string, kind string, n bigint, amount bigint"


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = whole_number(F.col("value"))
    return with_group_key(table(spark, sf_dir, "events"), ["user_id"]).select(
        KEY, F.lit(1).cast("bigint").alias("n"), cents.alias("cents"), cents.alias("top")
    )


def grouped_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A module that emits one or two rows for each group, over partly combined groups."""
    return group_apply(_user_events(spark, sf_dir), _user_rows, USER_SCHEMA, partial=_user_totals)


def grouped_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same module, called for many groups at once."""
    return group_frames(_user_events(spark, sf_dir), _user_frames, USER_SCHEMA, partial=_user_totals)


def _sum_quantity(_: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = quantity = 0
    for rows in batches:
        n += int(rows["n"].sum())
        quantity += int(rows["quantity"].sum())
    yield pd.DataFrame({"n": [n], "quantity": [quantity]})


def grouped_combiner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An associative module that is its own combiner."""
    lines = with_group_key(table(spark, sf_dir, "lineitem"), ["l_suppkey"])
    rows = lines.select(
        KEY, F.lit(1).cast("bigint").alias("n"), F.col("l_quantity").cast("bigint").alias("quantity")
    )
    return group_apply(rows, _sum_quantity, f"{KEY} string, n bigint, quantity bigint")


def _length_counts(rows: pd.DataFrame) -> pd.DataFrame:
    return rows.groupby([KEY, "length"], as_index=False, sort=False)["n"].sum()


def _median_length(_: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    lengths = pd.concat(batches).groupby("length")["n"].sum().sort_index()
    words = int(lengths.sum())
    reached = lengths.cumsum().searchsorted((words + 1) // 2)
    yield pd.DataFrame({"words": [words], "median_length": [int(lengths.index[reached])]})


def grouped_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A median over few, large groups: groups become counts per value, on salted keys."""
    word = F.explode(F.split("text", " ")).alias("word")
    lengths = with_group_key(table(spark, sf_dir, "documents"), ["lang"]).select(KEY, word)
    counts = lengths.select(KEY, F.length("word").cast("bigint").alias("length"), F.lit(1).cast("bigint").alias("n"))
    schema = f"{KEY} string, words bigint, median_length bigint"
    return group_apply(counts, _median_length, schema, partial=_length_counts, salts=8)


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _begins(rows: pd.DataFrame) -> np.ndarray:
    """Whether a row is the first of its group."""
    return (rows[KEY] != rows[KEY].shift()).to_numpy()


class LongestGap(GroupScan):
    """Of a customer's orders, the most days between one and the next that are known.

    A state: orders, first known day, last known day, gap.
    """

    state = "orders bigint, first bigint, last bigint, gap bigint"

    def summary(self, rows):
        days = rows["day"].dropna()
        if days.empty:
            return len(rows), None, None, 0
        return len(rows), int(days.iloc[0]), int(days.iloc[-1]), int(days.diff().max()) if len(days) > 1 else 0

    def merge(self, first, second):
        orders = first[0] + second[0]
        if pd.isna(first[1]) or pd.isna(second[1]):
            return orders, *(second if pd.isna(first[1]) else first)[1:]
        return orders, first[1], second[2], max(first[3], second[3], second[1] - first[2])

    def run(self, key, before, rows, last):
        for some in rows:
            own = self.summary(some)
            before = own if before is None else self.merge(before, own)
        if last:
            yield pd.DataFrame({"orders": [before[0]], "longest_gap": [before[3]]})

    def whole(self, rows):
        begins = _begins(rows)
        gaps = rows["day"].diff().fillna(0).mask(begins, 0).astype("int64").to_numpy()
        first = np.flatnonzero(begins)
        orders = np.diff([*first, len(rows)])
        yield pd.DataFrame(
            {KEY: rows[KEY].to_numpy()[first], "orders": orders, "longest_gap": np.maximum.reduceat(gaps, first)}
        )


class Gaps(LongestGap):
    """Of every order, its place among the group's and the days since the one before; 0 if one is not known."""

    def run(self, key, before, rows, last):
        for some in rows:
            nth = (before[0] if before else 0) + np.arange(1, len(some) + 1)
            gap = some["day"].diff()
            gap.iloc[0] = some["day"].iloc[0] - before[2] if before and not pd.isna(before[2]) else 0
            gap = gap.fillna(0).astype("int64")
            yield pd.DataFrame({"o_orderkey": some["o_orderkey"], "nth": nth.astype("int64"), "gap": gap})
            own = self.summary(some)
            before = own if before is None else self.merge(before, own)

    def whole(self, rows):
        begins = _begins(rows)
        places = np.arange(len(rows))
        nth = places - np.maximum.accumulate(np.where(begins, places, 0)) + 1
        gap = rows["day"].diff().fillna(0).mask(begins, 0).astype("int64")
        yield pd.DataFrame({KEY: rows[KEY], "o_orderkey": rows["o_orderkey"], "nth": nth, "gap": gap})


_DAY = "unix_date(cast(o_orderdate as date))"


def grouped_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A module that has to see all orders of a customer in their order, however many there are."""
    schema = f"{KEY} string, orders bigint, longest_gap bigint"
    stage = Stage("gaps", lambda df: group_scan(df, LongestGap(), schema, ["day"]), grouping_fields=("o_custkey",))
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.expr(_DAY).cast("bigint").alias("day"))
    return run_stages(orders, [stage])


def grouped_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per order, of which one group holds a third: segments go on where the one before has ended."""
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_custkey")).alias("customer"),
        F.expr(_DAY).cast("bigint").alias("day"),
        "o_orderkey",
    )
    schema = f"{KEY} string, o_orderkey bigint, nth bigint, gap bigint"
    order = [F.col("day").asc_nulls_last(), F.col("o_orderkey").asc_nulls_last()]
    found = group_scan(with_group_key(orders, ["customer"]), Gaps(), schema, order, segment_rows=2000)
    return found.select("o_orderkey", "nth", "gap")


def exact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times to the microsecond, and numbers that no double holds, make different keys."""
    events = table(spark, sf_dir, "events")
    digits = F.concat(F.lit('{"x":0.12345678901234567890'), F.col("user_id").cast("string"), F.lit("7}"))
    exact = with_group_key(events.withColumn("json", digits), ["x"], json="json")
    seconds = "make_dt_interval(0, 0, 0, CAST(user_id / 1000000 AS DECIMAL(18, 6)))"
    instant = F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + {seconds} AS at")
    return group_agg(exact, row_count()).unionByName(group_fields(events.select(instant), ["at"], row_count()))


def post_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages after a grouped one, and a second grouping after those."""

    stages = [
        Stage(
            "per_customer",
            aggregates=lambda: [row_count(), total_cents("o_totalprice")],
            grouping_fields=("o_custkey",),
            partitions=_tasks(spark),
        ),
        Stage("several", lambda df: df.where("n >= 2").withColumn("mean", F.expr("cents div n")).drop(KEY)),
        Stage("per_n", aggregates=lambda: [row_count(), F.max("mean").alias("mean")], grouping_fields=("n",)),
    ]
    return run_stages(table(spark, sf_dir, "orders"), stages)


def ordered_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group's place in the byte order of the keys."""
    groups = group_fields(table(spark, sf_dir, "orders"), ["o_custkey"], row_count())
    return with_ordinals(groups, [KEY], "place")


def _out_of_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last = ""
    for rows in batches:
        keys = [last, *rows[KEY]]
        last = keys[-1]
        # Keys are ASCII, so Python compares them as bytes would be.
        later = [int(b < a) for a, b in zip(keys, keys[1:], strict=False)]
        yield pd.DataFrame({"records": [len(rows)], "out_of_order": [sum(later)]})


def groups_sorted_in_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups arrive in key order in every partition."""
    groups = group_fields(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_returnflag"], row_count())
    ordered = groups_in_key_order(groups, partitions=_tasks(spark))
    seen = ordered.select(KEY).mapInPandas(_out_of_order, "records bigint, out_of_order bigint")
    return seen.agg(F.sum("records").alias("records"), F.sum("out_of_order").alias("out_of_order"))


_K = "json_extract_string(props, '$.k')"

_USERS_SQL = """
    WITH users AS (
        SELECT '{"user_id":' || user_id || '}' AS group_key, count(*) AS n,
               sum(round(value * 100)::BIGINT)::BIGINT AS cents, max(round(value * 100)::BIGINT) AS top
        FROM events GROUP BY user_id)
    SELECT group_key, 'total' AS kind, n, cents AS amount FROM users
    UNION ALL SELECT group_key, 'top', n, top FROM users WHERE top > 20000
"""

QUERIES = {
    "group_key": Query(
        group_key,
        """
        SELECT '{"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus
               || '","l_linenumber":' || l_linenumber || '}' AS group_key,
               count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity
        FROM lineitem GROUP BY 1
        """,
    ),
    "group_key_nested": Query(
        group_key_nested,
        f"""
        SELECT CASE WHEN {_K}::INTEGER > 50 THEN '{{"props.k":' || {_K} || ',"event_type":"' || event_type || '"}}'
                    ELSE '{{"event_type":"' || event_type || '"}}' END AS group_key,
               count(*) AS n, sum(round(value * 100)::BIGINT)::BIGINT AS cents
        FROM events GROUP BY 1
        """,
    ),
    "group_key_missing": Query(
        group_key_missing,
        f"""
        SELECT CASE WHEN {_K}::INTEGER > 50 THEN '{{"props.k":' || {_K} || '}}' ELSE '{{}}' END AS group_key,
               count(*) AS n
        FROM events GROUP BY 1
        """,
    ),
    "group_key_untyped": Query(
        group_key_untyped,
        f"""
        SELECT CASE event_type WHEN 'click' THEN '{{"props.k":' || {_K} || '}}'
                               WHEN 'view' THEN '{{"props.k":' || {_K} || '.0}}'
                               WHEN 'error' THEN '{{"props.k":"' || {_K} || '"}}'
                               ELSE '{{}}' END AS group_key, count(*) AS n
        FROM events GROUP BY 1
        """,
    ),
    "explicit_key": Query(
        explicit_key,
        """
        SELECT CASE WHEN o_totalprice >= 400000 THEN '{"size":"large"}'
                    ELSE '{"o_orderstatus":"' || o_orderstatus || '"}' END AS group_key, count(*) AS n
        FROM orders GROUP BY 1
        """,
    ),
    "grouped_module": Query(grouped_module, _USERS_SQL),
    "grouped_frames": Query(grouped_frames, _USERS_SQL),
    "grouped_combiner": Query(
        grouped_combiner,
        """
        SELECT '{"l_suppkey":' || l_suppkey || '}' AS group_key, count(*) AS n,
               sum(l_quantity::BIGINT)::BIGINT AS quantity
        FROM lineitem GROUP BY l_suppkey
        """,
    ),
    "grouped_salted": Query(
        grouped_salted,
        """
        SELECT '{"lang":"' || lang || '"}' AS group_key, count(*) AS words,
               quantile_disc(length(word), 0.5)::BIGINT AS median_length
        FROM (SELECT lang, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY lang
        """,
    ),
    "grouped_whole": Query(
        grouped_whole,
        """
        SELECT '{"o_custkey":' || o_custkey || '}' AS group_key, count(*) AS orders,
               max(coalesce(gap, 0))::BIGINT AS longest_gap
        FROM (SELECT o_custkey, o_orderdate::DATE - lag(o_orderdate::DATE) OVER (
                  PARTITION BY o_custkey ORDER BY o_orderdate) AS gap FROM orders)
        GROUP BY o_custkey
        """,
    ),
    "grouped_scan": Query(
        grouped_scan,
        """
        SELECT o_orderkey, row_number() OVER orders AS nth,
               coalesce(day - lag(day) OVER orders, 0)::BIGINT AS gap
        FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS customer, o_orderkey,
                     o_orderdate::DATE AS day FROM orders)
        WINDOW orders AS (PARTITION BY customer ORDER BY day, o_orderkey)
        """,
    ),
    "exact_keys": Query(
        exact_keys,
        """
        SELECT '{"x":0.12345678901234567890' || user_id || '7}' AS group_key, count(*) AS n FROM events GROUP BY user_id
        UNION ALL
        SELECT '{"at":"' || strftime(make_timestamp(user_id::BIGINT), '%Y-%m-%dT%H:%M:%S.%f') || '"}', count(*)
        FROM events GROUP BY user_id
        """,
    ),
    "post_group": Query(
        post_group,
        """
        SELECT '{"n":' || orders_of || '}' AS group_key, count(*) AS n, max(mean) AS mean
        FROM (SELECT count(*) AS orders_of,
                     sum(round(o_totalprice * 100)::BIGINT)::BIGINT // count(*) AS mean
              FROM orders GROUP BY o_custkey HAVING count(*) >= 2)
        GROUP BY orders_of
        """,
    ),
    "ordered_groups": Query(
        ordered_groups,
        """
        SELECT group_key, n, row_number() OVER (ORDER BY group_key) AS place
        FROM (SELECT '{"o_custkey":' || o_custkey || '}' AS group_key, count(*) AS n FROM orders GROUP BY o_custkey)
        """,
    ),
    "groups_sorted_in_partitions": Query(
        groups_sorted_in_partitions,
        """
        SELECT count(*) AS records, 0::BIGINT AS out_of_order
        FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)
        """,
    ),
}
