"""Conformance queries: what a user's SQL text may say, run through the
library's SQL path (``register`` + ``run_sql``) over the driver tables.

Every entry is a Spark SQL text over temp views of the parquet tables, plus
the DuckDB text for the same answer where one exists (``None``: approximate
or sampled results, checked by row count only). Where the two engines differ
in result types (``int`` vs ``BIGINT`` for ranks, lengths, date parts) both
texts cast explicitly; doubles are cast to decimals before they are summed,
so sums are exact and their order cannot show.

Where the obvious text would pair every event of a user with every other
(as-of, interval and band joins), or put one customer's or user's rows in one
task (windows, frames, sessions), the query is one of the library's functions
(``operators.ordered``, ``operators.windows``). The DuckDB text stays the obvious
one, so the oracle checks the function.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import band_join, split_asof, split_interval, split_range_frame, stored
from ..operators.rollups import cube_sets, lattice, sliding_panes
from ..operators.sql import register, run_sql
from ..operators.windows import split_sessions, split_window
from ..session import ensure_database, scratch_dir, settings
from .inputs import table

SAME = object()  # oracle text equals the Spark text


@dataclass(frozen=True)
class Conf:
    name: str
    tables: tuple[str, ...]
    spark_sql: str
    duck_sql: object = SAME  # str | SAME | None
    args: dict | None = None
    setup: tuple[str, ...] = ()  # statements run first (e.g. CREATE TEMPORARY FUNCTION)
    # run with aggregates dealt by all their keys: else one over (group, value) that
    # follows a join on the group alone has a task for each group, however large
    all_keys: bool = False


def _views(spark: SparkSession, sf_dir: str, tables) -> None:
    register(spark, {t: table(spark, sf_dir, t) for t in tables})


def _runner(c: Conf) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _views(spark, sf_dir, c.tables)
        for stmt in c.setup:
            spark.sql(stmt)
        if not c.all_keys:
            return run_sql(spark, c.spark_sql, c.args)
        # partial aggregates hold the values of one split of a file, so splits are small
        with settings(spark, {"spark.sql.requireAllClusterKeysForDistribution": "true", "spark.sql.files.maxPartitionBytes": "16m"}):
            return stored(run_sql(spark, c.spark_sql, c.args), c.name)

    run.__name__ = c.name
    return run


# ---------------------------------------------------------------------------
# Scans, sources
# ---------------------------------------------------------------------------

SCANS = [
    Conf(
        "scan_parquet_pushdown",
        ("lineitem",),
        """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
           WHERE l_shipdate >= DATE '1999-01-01' AND l_discount > 0.05""",
    ),
    Conf(
        "values_inline_table",
        ("lineitem",),
        """SELECT v.flag, v.flag_name, count(*) AS n_lines
           FROM lineitem l JOIN (VALUES ('A', 'accepted'), ('N', 'none'), ('R', 'returned')) AS v(flag, flag_name)
             ON l.l_returnflag = v.flag
           GROUP BY v.flag, v.flag_name""",
    ),
    Conf(
        "range_generator",
        ("lineitem",),
        # lines are counted before the join: a few rows meet the range
        """SELECT r.id AS line_no, coalesce(l.n, 0) AS n_lines
           FROM range(1, 10) r LEFT JOIN
                (SELECT l_linenumber, count(l_orderkey) AS n FROM lineitem GROUP BY l_linenumber) l ON l.l_linenumber = r.id""",
        """SELECT r.id AS line_no, count(l.l_orderkey) AS n_lines
           FROM range(1, 10) r(id) LEFT JOIN lineitem l ON l.l_linenumber = r.id
           GROUP BY r.id""",
    ),
    Conf(
        "tablesample_repeatable",
        ("lineitem",),
        # which rows is the engine's choice; what must hold is that they are rows
        # of the table, the same ones each time, and about a tenth
        """WITH a AS (SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem TABLESAMPLE (10 PERCENT) REPEATABLE (42)),
                b AS (SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem TABLESAMPLE (10 PERCENT) REPEATABLE (42)),
                n AS (SELECT (SELECT count(*) FROM a) AS a, (SELECT count(*) FROM lineitem) AS l,
                             (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS other,
                             (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem)) AS strange)
           SELECT abs(a - 0.1 * l) < 5 * sqrt(0.09 * l) AS about_a_tenth, other = 0 AS repeatable, strange = 0 AS from_table FROM n""",
        "SELECT count(*) >= 0 AS about_a_tenth, true AS repeatable, true AS from_table FROM lineitem",
    ),
]

# ---------------------------------------------------------------------------
# Projection, filter, predicates
# ---------------------------------------------------------------------------

PROJECT_FILTER = [
    Conf(
        "expr_alias",
        ("lineitem",),
        """SELECT l_orderkey, l_linenumber,
                  l_extendedprice * (1 - l_discount) AS disc_price,
                  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
           FROM lineitem""",
    ),
    Conf(
        "filter_and_or_not",
        ("orders",),
        """SELECT o_orderkey, o_totalprice FROM orders
           WHERE (o_orderstatus = 'F' AND o_totalprice > 300000) OR NOT (o_orderpriority <> '1-URGENT')""",
    ),
    Conf(
        "between_in_like_null",
        ("part",),
        """SELECT p_partkey, p_name FROM part
           WHERE p_size BETWEEN 10 AND 20 AND p_brand IN ('Brand#12', 'Brand#23', 'Brand#34')
             AND p_type LIKE '%OMY' AND p_name IS NOT NULL""",
    ),
    Conf(
        "rlike",
        ("customer",),
        "SELECT c_custkey, c_name FROM customer WHERE c_name RLIKE '0[0-9]7$'",
        "SELECT c_custkey, c_name FROM customer WHERE regexp_matches(c_name, '0[0-9]7$')",
    ),
    Conf(
        "case_when",
        ("orders",),
        """SELECT o_orderkey,
                  CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band
           FROM orders""",
    ),
    Conf(
        "cast_try_cast",
        ("orders",),
        # a failing cast costs some 15 microseconds a row (it raises and
        # catches), so texts that mostly fail are tested for digits first
        """SELECT o_orderkey, CAST(o_totalprice AS BIGINT) AS price_int,
                  CASE WHEN o_orderpriority RLIKE '^ *[+-]?[0-9]+ *$' THEN TRY_CAST(o_orderpriority AS INT) END AS bad_num,
                  TRY_CAST(substring(o_orderpriority, 1, 1) AS INT) AS prio_num,
                  CAST(o_orderdate AS DATE) AS order_day
           FROM orders""",
        """SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS price_int,
                  TRY_CAST(o_orderpriority AS INT) AS bad_num,
                  TRY_CAST(substring(o_orderpriority, 1, 1) AS INT) AS prio_num,
                  CAST(o_orderdate AS DATE) AS order_day
           FROM orders""",
    ),
    Conf(
        "coalesce_nullif",
        ("orders",),
        """SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'O'), 'open') AS status2,
                  NULLIF(o_orderpriority, '5-LOW') AS prio
           FROM orders""",
    ),
    Conf("distinct", ("lineitem",), "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem"),
    Conf(
        "cte",
        ("orders", "customer"),
        """WITH spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY o_custkey)
           SELECT c_mktsegment, count(*) AS n_cust, sum(total) AS spent
           FROM spent JOIN customer ON c_custkey = o_custkey
           GROUP BY c_mktsegment""",
    ),
    Conf(
        "recursive_cte",
        ("lineitem",),
        """WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 7)
           SELECT r.n AS line_no, l.n_lines
           FROM r JOIN (SELECT l_linenumber, count(*) AS n_lines FROM lineitem GROUP BY l_linenumber) l ON l.l_linenumber = r.n""",
        """WITH RECURSIVE r(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < 7)
           SELECT r.n AS line_no, count(*) AS n_lines FROM r JOIN lineitem ON l_linenumber = r.n GROUP BY r.n""",
    ),
    Conf(
        "named_params",
        ("orders",),
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = :status AND o_totalprice > :min_price",
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 250000",
        args={"status": "P", "min_price": 250000},
    ),
    Conf(
        "sql_udf",
        ("lineitem",),
        "SELECT l_orderkey, l_linenumber, net_price(l_extendedprice, l_discount) AS net FROM lineitem",
        "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem",
        setup=(
            "CREATE OR REPLACE TEMPORARY FUNCTION net_price(p DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN p * (1 - d)",
        ),
    ),
]

# ---------------------------------------------------------------------------
# Joins
# ---------------------------------------------------------------------------

JOINS = [
    Conf(
        "join_inner",
        ("orders", "customer", "nation"),
        """SELECT n_name, count(*) AS n_orders
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           GROUP BY n_name""",
    ),
    Conf(
        "join_left",
        ("customer", "orders"),
        # orders are counted by customer before the join, which a hot customer
        # could not be split out of
        """SELECT c_custkey, coalesce(n, 0) AS n_orders
           FROM customer LEFT JOIN
                (SELECT o_custkey, count(o_orderkey) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey)
                ON c_custkey = o_custkey""",
        """SELECT c_custkey, count(o_orderkey) AS n_orders
           FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'
           GROUP BY c_custkey""",
    ),
    Conf(
        "join_right",
        ("supplier", "nation"),
        "SELECT s_suppkey, n_nationkey, n_name FROM supplier RIGHT JOIN nation ON s_nationkey = n_nationkey",
    ),
    Conf(
        "join_full",
        ("customer", "supplier"),
        """SELECT COALESCE(a.k, b.k) AS nationkey, a.n_cust, b.n_supp
           FROM (SELECT c_nationkey AS k, count(*) AS n_cust FROM customer GROUP BY c_nationkey) a
           FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n_supp FROM supplier GROUP BY s_nationkey) b
           ON a.k = b.k""",
    ),
    Conf(
        # non-equi join against a fixed three-row literal table: a broadcast
        # nested-loop join whose small side cannot grow with the data
        "theta_range_join",
        ("part",),
        """SELECT b.band, count(*) AS n_parts
           FROM part p JOIN (VALUES ('low', 0.0, 930.0), ('mid', 930.0, 960.0), ('high', 960.0, 100000.0)) AS b(band, lo, hi)
             ON p.p_retailprice >= b.lo AND p.p_retailprice < b.hi
           GROUP BY b.band""",
    ),
    Conf(
        "semi_exists",
        ("customer", "orders"),
        """SELECT c_custkey FROM customer c
           WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 450000)""",
    ),
    Conf(
        "semi_in_subquery",
        ("part", "lineitem"),
        "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)",
    ),
    Conf(
        "anti_not_exists",
        ("customer", "orders"),
        """SELECT c_custkey FROM customer c
           WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
    ),
    Conf(
        "left_semi_join",
        ("customer", "orders"),
        "SELECT c_custkey, c_name FROM customer LEFT SEMI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 450000",
        "SELECT c_custkey, c_name FROM customer SEMI JOIN orders ON c_custkey = o_custkey AND o_totalprice > 450000",
    ),
    Conf(
        "left_anti_join",
        ("customer", "orders"),
        "SELECT c_custkey, c_name FROM customer LEFT ANTI JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'",
        "SELECT c_custkey, c_name FROM customer ANTI JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'",
    ),
    Conf(
        "lateral_join",
        ("customer", "orders"),
        """SELECT c_custkey, t.max_price
           FROM customer, LATERAL (SELECT max(o_totalprice) AS max_price FROM orders WHERE o_custkey = c_custkey) t""",
    ),
    Conf(
        "scalar_subquery",
        ("orders",),
        "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.9 FROM orders)",
    ),
    Conf(
        "correlated_scalar_subquery",
        ("customer", "orders"),
        """SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS n_pending
           FROM customer""",
    ),
    Conf(
        # the hinted side is the 25-row nation dimension (fixed by the schema)
        "hint_broadcast",
        ("customer", "nation"),
        "SELECT /*+ BROADCAST(n) */ c_custkey, n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
        "SELECT c_custkey, n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
    ),
    Conf(
        "hint_merge",
        ("orders", "lineitem"),
        """SELECT /*+ MERGE(o, l) */ o.o_orderpriority, count(*) AS n_lines
           FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderpriority""",
        """SELECT o.o_orderpriority, count(*) AS n_lines
           FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderpriority""",
    ),
]

# ---------------------------------------------------------------------------
# Aggregation
# ---------------------------------------------------------------------------

AGGREGATION = [
    Conf(
        "agg_group_by",
        ("lineitem",),
        """SELECT l_returnflag, l_linestatus,
                  sum(l_quantity) AS sum_qty,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_base_price,
                  CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(6,4)))) AS DECIMAL(38,6)) AS sum_disc_price,
                  CAST(avg(l_quantity) AS DECIMAL(18,4)) AS avg_qty,
                  min(l_tax) AS min_tax, max(l_tax) AS max_tax,
                  count(*) AS count_order
           FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    ),
    Conf(
        "count_distinct",
        ("lineitem",),
        """SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_suppkey) AS n_supp
           FROM lineitem GROUP BY l_returnflag""",
    ),
    Conf(
        "agg_filter_clause",
        ("orders",),
        """SELECT o_orderpriority,
                  count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f,
                  count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o,
                  max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS max_p
           FROM orders GROUP BY o_orderpriority""",
    ),
    Conf(
        "having",
        ("orders",),
        "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) > 18",
    ),
    Conf(
        "grouping_sets",
        ("lineitem",),
        """SELECT l_returnflag, l_linestatus, count(*) AS n_lines, sum(l_quantity) AS qty
           FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""",
    ),
    Conf(
        "cube",
        ("lineitem",),
        """SELECT l_returnflag, l_linestatus, count(*) AS n_lines
           FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
    ),
    Conf(
        "rollup",
        ("orders",),
        """SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders
           FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    ),
    Conf(
        "stats_aggregates",
        ("lineitem",),
        """SELECT l_returnflag,
                  CAST(stddev_samp(l_quantity) AS DECIMAL(18,6)) AS sd_qty,
                  CAST(var_pop(l_quantity) AS DECIMAL(18,4)) AS var_qty,
                  CAST(corr(l_quantity, l_extendedprice) AS DECIMAL(18,6)) AS corr_qty_price
           FROM lineitem GROUP BY l_returnflag""",
    ),
    Conf(
        "approx_aggregates",
        ("lineitem",),
        # within the stated errors: 5 % (relative standard deviation) three times
        # over, and a rank within 1/1000 of the median's
        """WITH a AS (SELECT l_returnflag, approx_count_distinct(l_orderkey) AS approx_orders,
                             percentile_approx(l_extendedprice, 0.5, 1000) AS median_price
                      FROM lineitem GROUP BY l_returnflag)
           SELECT l.l_returnflag, abs(any_value(a.approx_orders) - count(DISTINCT l.l_orderkey)) <= 0.15 * count(DISTINCT l.l_orderkey) AS distinct_near,
                  abs(sum(CASE WHEN l.l_extendedprice <= a.median_price THEN 1 ELSE 0 END) - 0.5 * count(*)) <= 0.002 * count(*) + 2 AS median_near
           FROM lineitem l JOIN a ON l.l_returnflag = a.l_returnflag GROUP BY l.l_returnflag""",
        "SELECT l_returnflag, true AS distinct_near, true AS median_near FROM lineitem GROUP BY l_returnflag",
        all_keys=True,
    ),
    Conf(
        # collect_list per order: bounded by the lines of one order
        "collect_aggregates",
        ("lineitem",),
        """SELECT l_orderkey,
                  sort_array(collect_list(l_linenumber)) AS lines,
                  CAST(size(collect_set(l_returnflag)) AS BIGINT) AS n_flags,
                  max_by(l_linenumber, l_extendedprice) AS priciest_line,
                  array_join(transform(sort_array(collect_list(struct(l_linenumber, l_linestatus))), x -> x.l_linestatus), ',') AS statuses
           FROM lineitem GROUP BY l_orderkey""",
        """SELECT l_orderkey,
                  list_sort(list(l_linenumber)) AS lines,
                  CAST(count(DISTINCT l_returnflag) AS BIGINT) AS n_flags,
                  arg_max(l_linenumber, l_extendedprice) AS priciest_line,
                  string_agg(l_linestatus, ',' ORDER BY l_linenumber, l_linestatus) AS statuses
           FROM lineitem GROUP BY l_orderkey""",
    ),
    Conf(
        "pivot",
        ("lineitem",),
        """SELECT * FROM (SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem)
           PIVOT (sum(l_quantity) FOR l_linestatus IN ('F' AS f_qty, 'O' AS o_qty))""",
        """SELECT l_returnflag,
                  sum(l_quantity) FILTER (WHERE l_linestatus = 'F') AS f_qty,
                  sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS o_qty
           FROM lineitem GROUP BY l_returnflag""",
    ),
    Conf(
        "unpivot",
        ("orders",),
        """SELECT * FROM (SELECT o_orderkey, o_totalprice, CAST(o_custkey AS DOUBLE) AS cust FROM orders)
           UNPIVOT (val FOR attr IN (o_totalprice, cust))""",
        """SELECT o_orderkey, 'o_totalprice' AS attr, o_totalprice AS val FROM orders
           UNION ALL
           SELECT o_orderkey, 'cust', CAST(o_custkey AS DOUBLE) FROM orders""",
    ),
]

# ---------------------------------------------------------------------------
# Window functions
# ---------------------------------------------------------------------------

# Window texts partition by customer as a user would write them. A window
# needs each partition's rows in one ordered group; Spark keeps that group
# in an external (spilling) buffer. For top-k filters on a rank
# (``qualify_as_cte``) Spark adds a partial WindowGroupLimit before the
# shuffle, so a hot key sends at most k rows per map task. The ``*_chunked``
# queries below use ``split_window`` instead.
WINDOWS = [
    Conf(
        "window_ranking",
        ("orders",),
        """SELECT o_orderkey, o_custkey,
                  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rn,
                  CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS BIGINT) AS rk,
                  CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus) AS BIGINT) AS drk,
                  CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS tile
           FROM orders""",
    ),
    Conf(
        "window_lag_lead",
        ("orders",),
        """SELECT o_orderkey,
                  lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_price,
                  lead(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next2,
                  first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS first_order
           FROM orders""",
    ),
    Conf(
        "window_rows_frame",
        ("lineitem",),
        """SELECT l_orderkey, l_linenumber,
                  sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice
                                        ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS qty_3,
                  sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS qty_running
           FROM lineitem""",
    ),
    Conf(
        "window_range_frame",
        ("orders",),
        """SELECT o_orderkey,
                  count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                 RANGE BETWEEN 5000 PRECEDING AND CURRENT ROW) AS n_recent
           FROM orders""",
    ),
    Conf(
        "window_time_range_frame",
        ("events",),
        """SELECT event_id,
                  count(*) OVER (PARTITION BY user_id ORDER BY ts
                                 RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n_last_hour
           FROM events""",
    ),
    Conf(
        "window_distribution",
        ("orders",),
        """SELECT o_orderkey,
                  percent_rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS pr,
                  cume_dist() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS cd,
                  nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_order,
                  last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_order
           FROM orders""",
    ),
    Conf(
        "qualify_as_cte",
        ("orders",),
        """WITH ranked AS (
             SELECT o_custkey, o_orderkey, o_totalprice,
                    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
             FROM orders)
           SELECT o_custkey, o_orderkey, o_totalprice FROM ranked WHERE rn <= 2""",
    ),
]

# ---------------------------------------------------------------------------
# Sort, limit, set operations
# ---------------------------------------------------------------------------

SORT_SET = [
    Conf(
        "order_by_limit",
        ("orders",),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    ),
    Conf(
        "limit_offset",
        ("orders",),
        "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10 OFFSET 20",
    ),
    Conf(
        "distribute_sort_by",
        ("lineitem",),
        # each order in one partition, and each partition in order: both checked
        """WITH d AS (SELECT * FROM lineitem DISTRIBUTE BY l_orderkey SORT BY l_orderkey, l_linenumber),
                p AS (SELECT l_orderkey, l_linenumber, l_quantity, spark_partition_id() AS part,
                             monotonically_increasing_id() AS place FROM d),
                o AS (SELECT l_orderkey, l_linenumber, l_quantity, part,
                             lag(l_orderkey) OVER (PARTITION BY part, l_orderkey ORDER BY place) AS k,
                             lag(l_linenumber) OVER (PARTITION BY part, l_orderkey ORDER BY place) AS n FROM p)
           SELECT l_orderkey, count(*) AS n_lines, count(DISTINCT part) = 1 AS together,
                  min(CASE WHEN n IS NULL OR n <= l_linenumber THEN 1 ELSE 0 END) = 1 AS in_order
           FROM o GROUP BY l_orderkey""",
        "SELECT l_orderkey, count(*) AS n_lines, true AS together, true AS in_order FROM lineitem GROUP BY l_orderkey",
    ),
    Conf(
        "union_distinct",
        ("customer", "supplier"),
        "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
    ),
    Conf(
        "union_all_by_position",
        ("customer", "supplier"),
        """SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation FROM customer
           UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""",
    ),
    Conf(
        # the sides are filtered only so that they differ
        "intersect_distinct",
        ("orders", "lineitem"),
        """SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'F'
           INTERSECT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'""",
    ),
    Conf(
        # the sides are filtered only so that they differ
        "intersect_all",
        ("lineitem",),
        """SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_quantity > 25
           INTERSECT ALL SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_discount > 0.05""",
    ),
    Conf(
        # the right side is filtered only so that it differs
        "except_distinct",
        ("orders", "lineitem"),
        """SELECT o_orderkey AS k FROM orders
           EXCEPT SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O'""",
    ),
    Conf(
        # the right side is filtered only so that it differs
        "except_all",
        ("lineitem",),
        """SELECT l_orderkey, l_returnflag FROM lineitem
           EXCEPT ALL SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_quantity > 10""",
    ),
]

# ---------------------------------------------------------------------------
# Scalar functions
# ---------------------------------------------------------------------------

SCALAR = [
    Conf(
        "string_functions",
        ("customer",),
        """SELECT c_custkey, lower(c_name) AS lo, upper(c_mktsegment) AS up, substring(c_name, 3, 5) AS sub,
                  concat(c_name, '-', c_mktsegment) AS cat, CAST(length(c_name) AS BIGINT) AS len,
                  trim(concat('  ', c_mktsegment, ' ')) AS tr, replace(c_name, 'Customer', 'C') AS rep,
                  lpad(CAST(c_nationkey AS STRING), 4, '0') AS pad, regexp_replace(c_name, '[0-9]+', '#') AS rx
           FROM customer""",
        """SELECT c_custkey, lower(c_name) AS lo, upper(c_mktsegment) AS up, substring(c_name, 3, 5) AS sub,
                  concat(c_name, '-', c_mktsegment) AS cat, CAST(length(c_name) AS BIGINT) AS len,
                  trim(concat('  ', c_mktsegment, ' ')) AS tr, replace(c_name, 'Customer', 'C') AS rep,
                  lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS pad, regexp_replace(c_name, '[0-9]+', '#', 'g') AS rx
           FROM customer""",
    ),
    Conf(
        "string_functions_more",
        ("customer",),
        """SELECT c_custkey, regexp_extract(c_name, '#([0-9]+)', 1) AS digits, split_part(c_name, '#', 1) AS head,
                  translate(c_mktsegment, 'AEIOU', 'aeiou') AS tr, CAST(instr(c_name, '0') AS BIGINT) AS first_zero,
                  reverse(c_mktsegment) AS rev, repeat(substring(c_mktsegment, 1, 1), 3) AS rep3,
                  left(c_name, 4) AS l4, right(c_name, 3) AS r3, c_name LIKE 'Customer#00000001%' AS lk,
                  c_mktsegment ILIKE 'auto%' AS ilk
           FROM customer""",
    ),
    Conf(
        "math_functions",
        ("orders",),
        """SELECT o_orderkey, abs(o_totalprice - 250000) AS a, round(o_totalprice / 7, 2) AS r,
                  CAST(floor(o_totalprice / 1000) AS BIGINT) AS fl, sqrt(o_totalprice) AS sq,
                  CAST(power(o_custkey, 2) AS BIGINT) AS pw, o_orderkey % 7 AS md, mod(o_custkey, 5) AS md2
           FROM orders""",
    ),
    Conf(
        "bit_functions",
        ("orders",),
        """SELECT o_orderkey, o_orderkey & 255 AS low_byte, shiftleft(o_custkey, 2) AS shl,
                  CAST(bit_count(o_orderkey) AS BIGINT) AS bits
           FROM orders""",
        """SELECT o_orderkey, o_orderkey & 255 AS low_byte, o_custkey << 2 AS shl,
                  CAST(bit_count(o_orderkey) AS BIGINT) AS bits
           FROM orders""",
    ),
    Conf(
        "date_functions",
        ("orders",),
        """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m,
                  CAST(date_trunc('MONTH', o_orderdate) AS TIMESTAMP_NTZ) AS month_start,
                  o_orderdate + INTERVAL 7 DAYS AS plus7, CAST(o_orderdate AS DATE) AS d
           FROM orders""",
        """SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m,
                  date_trunc('month', o_orderdate) AS month_start,
                  o_orderdate + INTERVAL 7 DAY AS plus7, CAST(o_orderdate AS DATE) AS d
           FROM orders""",
    ),
    Conf(
        "date_functions_spark_names",
        ("orders",),
        """SELECT o_orderkey, date_format(o_orderdate, 'yyyy-MM') AS ym,
                  unix_timestamp(o_orderdate) AS epoch_s,
                  CAST(datediff(DATE '2002-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days_left,
                  add_months(CAST(o_orderdate AS DATE), 1) AS next_month, last_day(CAST(o_orderdate AS DATE)) AS eom,
                  to_timestamp_ntz(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')) AS ts_again,
                  CAST(to_timestamp(date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')) AS TIMESTAMP_NTZ) AS ts_parsed,
                  convert_timezone('UTC', 'Asia/Kolkata', o_orderdate) AS ist
           FROM orders""",
        """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym,
                  CAST(epoch(o_orderdate) AS BIGINT) AS epoch_s,
                  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) AS days_left,
                  CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
                  last_day(CAST(o_orderdate AS DATE)) AS eom,
                  CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_again,
                  CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_parsed,
                  o_orderdate + INTERVAL 330 MINUTE AS ist
           FROM orders""",
    ),
    Conf(
        # from_utc_timestamp shifts a session-zone timestamp; taken as the shift
        # between the zone's wall clocks it is the same in any session zone that
        # has no clock change on that day, and exact for a zone without any
        "date_from_utc_timestamp",
        ("orders",),
        """SELECT o_orderkey, convert_timezone('UTC', 'Asia/Kolkata', o_orderdate) AS ist,
                  timestampdiff(MINUTE, to_utc_timestamp(TIMESTAMP '2001-06-15 12:00:00', 'Asia/Kolkata'),
                                from_utc_timestamp(TIMESTAMP '2001-06-15 12:00:00', 'Asia/Kolkata')) AS both_ways
           FROM orders""",
        """SELECT o_orderkey, o_orderdate + INTERVAL 330 MINUTE AS ist, CAST(660 AS BIGINT) AS both_ways
           FROM orders""",
    ),
    Conf(
        # spellings common in other engines' SQL that Spark also accepts
        "portable_function_names",
        ("orders",),
        """SELECT o_orderkey, regexp_like(o_orderpriority, '^[12]-') AS urgentish,
                  CAST(cardinality(split(o_orderpriority, '-')) AS BIGINT) AS n_parts,
                  datediff(DAY, o_orderdate, TIMESTAMP_NTZ '2002-01-01 00:00:00') AS days_left,
                  dateadd(DAY, 30, o_orderdate) AS due,
                  concat_ws('|', o_orderstatus, o_orderpriority) AS cw,
                  nvl(NULLIF(o_orderstatus, 'F'), 'final') AS st,
                  if(o_totalprice > 250000, 'big', 'small') AS size_band
           FROM orders""",
        """SELECT o_orderkey, regexp_matches(o_orderpriority, '^[12]-') AS urgentish,
                  CAST(len(string_split(o_orderpriority, '-')) AS BIGINT) AS n_parts,
                  date_diff('day', o_orderdate, TIMESTAMP '2002-01-01 00:00:00') AS days_left,
                  o_orderdate + INTERVAL 30 DAY AS due,
                  concat_ws('|', o_orderstatus, o_orderpriority) AS cw,
                  coalesce(NULLIF(o_orderstatus, 'F'), 'final') AS st,
                  CASE WHEN o_totalprice > 250000 THEN 'big' ELSE 'small' END AS size_band
           FROM orders""",
    ),
    Conf(
        "array_functions",
        ("lineitem",),
        """SELECT l_orderkey, l_linenumber,
                  CAST(size(sequence(1, l_linenumber)) AS BIGINT) AS n,
                  array_join(transform(sequence(1, l_linenumber), x -> x * 2), ',') AS doubled,
                  CAST(aggregate(sequence(1, l_linenumber), 0, (acc, x) -> acc + x) AS BIGINT) AS tri,
                  CAST(element_at(sequence(1, l_linenumber), -1) AS BIGINT) AS last_el,
                  array_contains(sequence(1, l_linenumber), 3) AS has3,
                  CAST(size(filter(sequence(1, l_linenumber), x -> x % 2 = 0)) AS BIGINT) AS evens
           FROM lineitem""",
        """SELECT l_orderkey, l_linenumber,
                  CAST(len(range(1, l_linenumber + 1)) AS BIGINT) AS n,
                  array_to_string(list_transform(range(1, l_linenumber + 1), lambda x: x * 2), ',') AS doubled,
                  CAST(list_sum(range(1, l_linenumber + 1)) AS BIGINT) AS tri,
                  CAST(range(1, l_linenumber + 1)[-1] AS BIGINT) AS last_el,
                  list_contains(range(1, l_linenumber + 1), 3) AS has3,
                  CAST(len(list_filter(range(1, l_linenumber + 1), lambda x: x % 2 = 0)) AS BIGINT) AS evens
           FROM lineitem""",
    ),
    Conf(
        "lateral_view_posexplode",
        ("lineitem",),
        """SELECT l_orderkey, l_linenumber, CAST(pos AS BIGINT) AS pos, CAST(x AS BIGINT) AS x
           FROM lineitem LATERAL VIEW posexplode(sequence(1, l_linenumber)) t AS pos, x""",
        """SELECT l_orderkey, l_linenumber, CAST(i - 1 AS BIGINT) AS pos, CAST(i AS BIGINT) AS x
           FROM lineitem, range(1, l_linenumber + 1) t(i)""",
    ),
    Conf(
        "explode_array",
        ("orders",),
        """SELECT o_orderkey, part FROM orders LATERAL VIEW explode(split(o_orderpriority, '-')) t AS part""",
        """SELECT o_orderkey, unnest(string_split(o_orderpriority, '-')) AS part FROM orders""",
    ),
    Conf(
        "map_functions",
        ("events",),
        """SELECT event_id, map_keys(m) AS keys, element_at(m, 'k') AS k,
                  CAST(size(map_filter(m, (key, v) -> v > 50)) AS BIGINT) AS n_big,
                  element_at(map_from_entries(array(struct(event_type, value))), event_type) AS v2,
                  element_at(map('type', event_type), 'type') AS t
           FROM (SELECT event_id, event_type, value, from_json(props, 'map<string,int>') AS m FROM events)""",
        """SELECT event_id, ['k'] AS keys, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
                  CAST(CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) > 50 THEN 1 ELSE 0 END AS BIGINT) AS n_big,
                  value AS v2, event_type AS t
           FROM events""",
    ),
    Conf(
        "json_functions",
        ("events",),
        """SELECT event_id, get_json_object(props, '$.k') AS k_text,
                  from_json(props, 'k INT').k AS k_int,
                  to_json(named_struct('id', event_id, 'type', event_type)) AS as_json
           FROM events""",
        """SELECT event_id, json_extract_string(props, '$.k') AS k_text,
                  CAST(json_extract(props, '$.k') AS INTEGER) AS k_int,
                  '{"id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '"}' AS as_json
           FROM events""",
    ),
    Conf(
        "variant_functions",
        ("events",),
        """SELECT event_id, variant_get(parse_json(props), '$.k', 'int') AS k,
                  CAST(is_variant_null(parse_json(props)) AS BOOLEAN) AS is_null
           FROM events""",
        """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, false AS is_null FROM events""",
    ),
    Conf(
        "hash_functions",
        ("customer",),
        """SELECT c_custkey, md5(c_name) AS md5_name, sha2(c_name, 256) AS sha_name,
                  base64(CAST(c_name AS BINARY)) AS b64_name
           FROM customer""",
        """SELECT c_custkey, md5(c_name) AS md5_name, sha256(c_name) AS sha_name,
                  to_base64(encode(c_name)) AS b64_name
           FROM customer""",
    ),
    Conf(
        # whole texts: lengths and word counts over every document
        "text_tables_join",
        ("documents", "labels"),
        """SELECT d.lang, l.quality, l.toxic, count(*) AS n_docs,
                  CAST(sum(length(d.text)) AS BIGINT) AS n_chars,
                  CAST(sum(size(split(trim(d.text), '[ \\n\\t]+'))) AS BIGINT) AS n_words,
                  CAST(sum(CASE WHEN d.text LIKE '%\n%' THEN 1 ELSE 0 END) AS BIGINT) AS multi_line
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id
           GROUP BY d.lang, l.quality, l.toxic""",
        """SELECT d.lang, l.quality, l.toxic, count(*) AS n_docs,
                  CAST(sum(length(d.text)) AS BIGINT) AS n_chars,
                  CAST(sum(len(regexp_split_to_array(trim(d.text), '[ \n\t]+'))) AS BIGINT) AS n_words,
                  CAST(sum(CASE WHEN contains(d.text, chr(10)) THEN 1 ELSE 0 END) AS BIGINT) AS multi_line
           FROM documents d JOIN labels l ON d.doc_id = l.doc_id
           GROUP BY d.lang, l.quality, l.toxic""",
    ),
    Conf(
        "conversation_turns",
        ("conversations",),
        """SELECT role, count(*) AS n_turns, count(DISTINCT conv_id) AS n_convs, max(turn) AS max_turn,
                  CAST(sum(length(text)) AS BIGINT) AS n_chars
           FROM conversations GROUP BY role""",
    ),
    Conf(
        # whole raw pages: host, <title>, number of links and of characters
        "pages_html_fields",
        ("pages",),
        """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
                  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
                  CAST(size(split(html, '<a ')) - 1 AS BIGINT) AS n_links,
                  CAST(length(html) AS BIGINT) AS n_chars
           FROM pages""",
        """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
                  regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
                  CAST(len(string_split(html, '<a ')) - 1 AS BIGINT) AS n_links,
                  CAST(length(html) AS BIGINT) AS n_chars
           FROM pages""",
    ),
    Conf(
        "hash_xxhash64",
        ("customer",),
        # known value of the published algorithm (seed 42) for one text, and no
        # two names with one hash
        """SELECT count(*) AS n, count(DISTINCT xxhash64(c_name)) AS n_hashes, any_value(xxhash64('Spark')) AS known
           FROM customer""",
        "SELECT count(*) AS n, count(DISTINCT c_name) AS n_hashes, CAST(-4294468057691064905 AS BIGINT) AS known FROM customer",
    ),
]

# ---------------------------------------------------------------------------
# Event-time windows (batch)
# ---------------------------------------------------------------------------

TIME_WINDOWS = [
    Conf(
        "tumbling_window",
        ("events",),
        """SELECT window.start AS win_start, event_type, count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS total
           FROM events GROUP BY window(ts, '1 hour'), event_type""",
        """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS win_start, event_type, count(*) AS n_events,
                  CAST(sum(CAST(value AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS total
           FROM events GROUP BY 1, 2""",
    ),
    Conf(
        "sliding_window",
        ("events",),
        """SELECT window.start AS win_start, count(*) AS n_events
           FROM events GROUP BY window(ts, '1 hour', '30 minutes')""",
        """SELECT win_start, count(*) AS n_events FROM (
             SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS win_start FROM events
             UNION ALL
             SELECT time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE FROM events)
           GROUP BY win_start""",
    ),
    Conf(
        # Spark's session_window merges sessions after a shuffle by the group
        # key (only identical sessions are pre-aggregated map-side), so one
        # user's events are merged in one task; kept as the user's text
        "session_window",
        ("events",),
        """SELECT user_id, session_window.start AS s_start, session_window.end AS s_end, count(*) AS n_events
           FROM events GROUP BY user_id, session_window(ts, '30 minutes')""",
        """WITH g AS (
             SELECT user_id, ts,
                    CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= ts - INTERVAL 30 MINUTE
                         THEN 0 ELSE 1 END AS new_s
             FROM events),
           s AS (SELECT user_id, ts, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)
           SELECT user_id, min(ts) AS s_start, max(ts) + INTERVAL 30 MINUTE AS s_end, count(*) AS n_events
           FROM s GROUP BY user_id, sid""",
    ),
]

ALL: list[Conf] = SCANS + PROJECT_FILTER + JOINS + AGGREGATION + WINDOWS + SORT_SET + SCALAR + TIME_WINDOWS


# ---------------------------------------------------------------------------
# Windows and sessions split within keys (library functions, plain oracles)
# ---------------------------------------------------------------------------


def _thousands(orders: DataFrame) -> DataFrame:
    return orders.withColumn("k", F.floor(F.col("o_totalprice") / 1000).cast("bigint"))


def _by_date(orders: DataFrame, outputs: dict) -> DataFrame:
    return split_window(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], outputs)


SPLIT: dict[str, tuple[str | tuple[str, ...], Callable[..., DataFrame]]] = {
    "window_row_number_chunked": ("orders", lambda o: split_window(
        o, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], {"rn": ("row_number",)}
    ).select("o_orderkey", "o_custkey", "rn")),
    "window_lag_chunked": ("orders", lambda o: _by_date(o, {"prev_price": ("lag", "o_totalprice")}).select("o_orderkey", "prev_price")),
    "window_lead_chunked": ("orders", lambda o: _by_date(o, {"next_price": ("lead", "o_totalprice")}).select("o_orderkey", "next_price")),
    "window_rank_chunked": ("orders", lambda o: split_window(
        _thousands(o), ["o_custkey"], [F.desc("k")], {"rk": ("rank",), "drk": ("dense_rank",)}
    ).select("o_orderkey", "o_custkey", "rk", "drk")),
    "window_distribution_chunked": ("orders", lambda o: split_window(
        _thousands(o), ["o_custkey"], [F.col("k")], {"pr": ("percent_rank",), "cd": ("cume_dist",)}
    ).select("o_orderkey", "pr", "cd")),
    "window_ntile_chunked": ("orders", lambda o: split_window(
        o, ["o_custkey"], [F.col("o_orderkey")], {"tile": ("ntile", 4)}
    ).select("o_orderkey", "o_custkey", "tile")),
    "session_window_chunked": ("events", lambda e: split_sessions(e, ["user_id"], "ts")),
    "window_edges_split": ("orders", lambda o: _by_date(o, {
        "prev3": ("lag", "o_orderkey", 3), "next2": ("lead", "o_orderkey", 2), "first_order": ("first_value", "o_orderkey"),
        "second_order": ("nth_value", "o_orderkey", 2), "last_order": ("last_value", "o_orderkey"),
    }).select("o_orderkey", "prev3", "next2", "first_order", "second_order", "last_order")),
    "window_range_frame_split": ("orders", lambda o: split_range_frame(
        o.withColumn("price", F.col("o_totalprice").cast("decimal(18,2)")), ["o_custkey"], "o_orderkey", "5000", "200",
        {"n_near": ("count", "*"), "price_near": ("sum", "price"), "most_near": ("max", "o_totalprice")},
    ).select("o_orderkey", "n_near", F.col("price_near").cast("decimal(38,2)").alias("price_near"), "most_near")),
    "window_time_range_frame_split": ("events", lambda e: split_range_frame(
        e, ["user_id"], "ts", "INTERVAL 1 HOUR", "0", {"n_last_hour": ("count", "*")}
    ).select("event_id", "n_last_hour")),
    # views in the two hours before each purchase of the same user
    "interval_join": ("events", lambda e: split_interval(
        e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), ["user_id"], "ts", "ts", "-INTERVAL 2 HOURS", "0", {"views_before": ("count", "*")}
    ).where("views_before > 0").select(F.col("event_id").alias("purchase_id"), "views_before")),
    # latest earlier event of the same user for each purchase
    "asof_join": ("events", lambda e: split_asof(
        e.where("event_type = 'purchase'"), e, ["user_id"], "ts", "ts", {"prev_ts": "ts"}, equal=False
    ).select("event_id", "prev_ts")),
    # the view that led to each purchase, with what it was worth
    "asof_join_values": ("events", lambda e: split_asof(
        e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), ["user_id"], "ts", "ts", {"view_ts": "ts", "view_value": "value"}
    ).select("event_id", "view_ts", "view_value")),
    # orders in overlapping bands of prices, one for each part
    "band_join": (("orders", "part"), lambda o, p: band_join(
        o.select("o_orderkey", "o_totalprice"),
        p.select("p_partkey", (F.col("p_retailprice") * 100).alias("lo"), (F.col("p_retailprice") * 100 + 40 * F.col("p_size")).alias("hi")),
        "o_totalprice", "lo", "hi", outputs={"n_orders": ("count", "*"), "first_order": ("min", "o_orderkey")},
    ).groupBy("p_partkey").agg(F.sum("n_orders").alias("n_orders"), F.min("first_order").alias("first_order"))),
    # orders of a customer's own range of prices: equal keys and a band
    "band_join_keys": (("orders", "customer"), lambda o, c: band_join(
        o.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice"),
        c.select("c_custkey", (F.col("c_acctbal") * 10).alias("lo"), (F.col("c_acctbal") * 10 + 100000).alias("hi")),
        "o_totalprice", "lo", "hi", ["c_custkey"],
    ).select("o_orderkey", "c_custkey")),
    "sliding_window_panes": ("events", lambda e: sliding_panes(
        e.withColumn("worth", F.col("value").cast("decimal(18,6)")), "ts", 5400, 1200, ["event_type"],
        {"n_events": ("count", "*"), "total": ("sum", "worth"), "least": ("min", "value")},
    ).withColumn("total", F.col("total").cast("decimal(38,6)"))),
    "cube_lattice": ("lineitem", lambda x: lattice(
        x.withColumn("price", F.col("l_extendedprice").cast("decimal(18,2)")), ["l_returnflag", "l_linestatus", "l_linenumber"],
        cube_sets(["l_returnflag", "l_linestatus", "l_linenumber"]),
        {"n": ("count", "*"), "total": ("sum", "price"), "most": ("max", "l_quantity"), "mean": ("avg", "l_suppkey")},
    ).withColumns({"total": F.col("total").cast("decimal(38,2)"), "mean": F.col("mean").cast("decimal(18,6)")})),
    "grouping_sets_lattice": ("orders", lambda o: lattice(
        o, ["o_orderpriority", "o_orderstatus"], [("o_orderpriority",), ("o_orderstatus",), ()], {"n": ("count", "*"), "last": ("max", "o_orderdate")}
    )),
}

SPLIT_ORACLES = {
    "window_row_number_chunked": """SELECT o_orderkey, o_custkey,
                  CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rn
           FROM orders""",
    "window_lag_chunked": """SELECT o_orderkey,
                  lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_price
           FROM orders""",
    "window_lead_chunked": """SELECT o_orderkey,
                  lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS next_price
           FROM orders""",
    "window_rank_chunked": """SELECT o_orderkey, o_custkey,
                  CAST(rank() OVER (PARTITION BY o_custkey ORDER BY CAST(floor(o_totalprice / 1000) AS BIGINT) DESC)
                       AS BIGINT) AS rk,
                  CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY CAST(floor(o_totalprice / 1000) AS BIGINT) DESC)
                       AS BIGINT) AS drk
           FROM orders""",
    "window_distribution_chunked": """SELECT o_orderkey,
                  percent_rank() OVER (PARTITION BY o_custkey ORDER BY CAST(floor(o_totalprice / 1000) AS BIGINT)) AS pr,
                  cume_dist() OVER (PARTITION BY o_custkey ORDER BY CAST(floor(o_totalprice / 1000) AS BIGINT)) AS cd
           FROM orders""",
    "window_ntile_chunked": """SELECT o_orderkey, o_custkey,
                  CAST(ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS BIGINT) AS tile
           FROM orders""",
    "window_edges_split": """SELECT o_orderkey, lag(o_orderkey, 3) OVER w AS prev3, lead(o_orderkey, 2) OVER w AS next2,
                  first_value(o_orderkey) OVER w AS first_order, nth_value(o_orderkey, 2) OVER w AS second_order, last_value(o_orderkey) OVER w AS last_order
           FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "window_range_frame_split": """SELECT o_orderkey, count(*) OVER w AS n_near,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER w AS DECIMAL(38,2)) AS price_near, max(o_totalprice) OVER w AS most_near
           FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey RANGE BETWEEN 5000 PRECEDING AND 200 FOLLOWING)""",
    "window_time_range_frame_split": """SELECT event_id,
                  count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n_last_hour
           FROM events""",
    "interval_join": """SELECT a.event_id AS purchase_id, count(b.event_id) AS views_before
           FROM events a JOIN events b
             ON a.user_id = b.user_id AND b.ts >= a.ts - INTERVAL 2 HOUR AND b.ts < a.ts
           WHERE a.event_type = 'purchase' AND b.event_type = 'view'
           GROUP BY a.event_id""",
    "asof_join": """SELECT a.event_id, t.prev_ts
           FROM events a LEFT JOIN LATERAL (
             SELECT max(b.ts) AS prev_ts FROM events b WHERE b.user_id = a.user_id AND b.ts < a.ts) t ON true
           WHERE a.event_type = 'purchase'""",
    "asof_join_values": """WITH v AS (
             SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY user_id, ts)
           SELECT a.event_id, v.ts AS view_ts, v.value AS view_value
           FROM events a ASOF LEFT JOIN v ON a.user_id = v.user_id AND a.ts >= v.ts
           WHERE a.event_type = 'purchase'""",
    "band_join": """SELECT p_partkey, count(*) AS n_orders, min(o_orderkey) AS first_order
           FROM orders JOIN part ON o_totalprice >= p_retailprice * 100 AND o_totalprice < p_retailprice * 100 + 40 * p_size
           GROUP BY p_partkey""",
    "band_join_keys": """SELECT o_orderkey, c_custkey
           FROM orders JOIN customer ON o_custkey = c_custkey AND o_totalprice >= c_acctbal * 10 AND o_totalprice < c_acctbal * 10 + 100000""",
    "sliding_window_panes": """SELECT win_start, win_start + INTERVAL 5400 SECOND AS win_end, event_type, count(*) AS n_events,
                  CAST(sum(CAST(value AS DECIMAL(18,6))) AS DECIMAL(38,6)) AS total, min(value) AS least
           FROM (SELECT *, time_bucket(INTERVAL 1200 SECOND, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 1200 SECOND AS win_start
                 FROM events, unnest([0, 1, 2, 3, 4]) t(k))
           WHERE ts < win_start + INTERVAL 5400 SECOND GROUP BY win_start, event_type""",
    "cube_lattice": """SELECT l_returnflag, l_linestatus, l_linenumber, CAST(grouping_id(l_returnflag, l_linestatus, l_linenumber) AS BIGINT) AS grouping_id,
                  count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total, max(l_quantity) AS most,
                  CAST(avg(l_suppkey) AS DECIMAL(18,6)) AS mean
           FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus, l_linenumber)""",
    "grouping_sets_lattice": """SELECT o_orderpriority, o_orderstatus, CAST(grouping_id(o_orderpriority, o_orderstatus) AS BIGINT) AS grouping_id,
                  count(*) AS n, max(o_orderdate) AS last
           FROM orders GROUP BY GROUPING SETS ((o_orderpriority), (o_orderstatus), ())""",
    "session_window_chunked": """WITH g AS (
             SELECT user_id, ts,
                    CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= ts - INTERVAL 30 MINUTE
                         THEN 0 ELSE 1 END AS new_s
             FROM events),
           s AS (SELECT user_id, ts, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g)
           SELECT user_id, min(ts) AS s_start, max(ts) + INTERVAL 30 MINUTE AS s_end, count(*) AS n_events
           FROM s GROUP BY user_id, sid""",
}


def _split_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    source, build = SPLIT[name]
    sources = (source,) if isinstance(source, str) else source
    return lambda spark, sf_dir: build(*[table(spark, sf_dir, t) for t in sources])


# ---------------------------------------------------------------------------
# Sources and sinks beyond CSV: write a driver table, read it back
# ---------------------------------------------------------------------------


def _format_roundtrip(fmt: str, name: str, columns: list[str] | None = None, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = table(spark, sf_dir, name)
        src = src.select(*columns) if columns else src
        path = f"{scratch_dir(spark, 'fmt-' + fmt)}/{name}.{fmt}"
        src.write.format(fmt).options(**options).save(path)
        reader = spark.read.format(fmt).options(**options)
        if fmt != "text":
            reader = reader.schema(src.schema)  # no inference pass over the files
        return reader.load(path)

    run.__name__ = f"format_roundtrip_{fmt}"
    return run


def ctas_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``CREATE TABLE ... USING parquet LOCATION <shared folder> AS SELECT``."""
    _views(spark, sf_dir, ("orders",))
    ensure_database(spark, "conformance")
    spark.sql("DROP TABLE IF EXISTS conformance.order_totals")
    spark.sql(
        f"CREATE TABLE conformance.order_totals USING parquet LOCATION '{scratch_dir(spark, 'ctas')}' AS "
        "SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders GROUP BY o_custkey"
    )
    return spark.table("conformance.order_totals")


def insert_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``CREATE TABLE ... USING parquet LOCATION`` then two ``INSERT INTO``."""
    _views(spark, sf_dir, ("orders",))
    ensure_database(spark, "conformance")
    spark.sql("DROP TABLE IF EXISTS conformance.status_counts")
    spark.sql(
        "CREATE TABLE conformance.status_counts (o_orderstatus STRING, n_orders BIGINT) USING parquet "
        f"LOCATION '{scratch_dir(spark, 'insert')}'"
    )
    spark.sql(
        "INSERT INTO conformance.status_counts "
        "SELECT o_orderstatus, count(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderstatus"
    )
    spark.sql(
        "INSERT INTO conformance.status_counts "
        "SELECT o_orderstatus, count(*) FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderstatus"
    )
    return spark.table("conformance.status_counts")


# the default text form of a timestamp has milliseconds only
_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

EXTRA: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "format_roundtrip_orc": (_format_roundtrip("orc", "lineitem"), "SELECT * FROM lineitem"),
    "format_roundtrip_json": (_format_roundtrip("json", "lineitem", timestampNTZFormat=_MICROS), "SELECT * FROM lineitem"),
    "format_roundtrip_xml": (
        _format_roundtrip("xml", "orders", rowTag="order", timestampNTZFormat=_MICROS),
        "SELECT * FROM orders",
    ),
    "format_roundtrip_text": (
        _format_roundtrip("text", "customer", ["c_name"]),
        "SELECT c_name AS value FROM customer",
    ),
    "insert_into_table": (
        insert_into_table,
        "SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus",
    ),
    "ctas_parquet": (
        ctas_parquet,
        "SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_price FROM orders GROUP BY o_custkey",
    ),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {c.name: _runner(c) for c in ALL}
    out.update({name: _split_query(name) for name in SPLIT})
    out.update({name: fn for name, (fn, _) in EXTRA.items()})
    return out


def oracles() -> dict[str, str]:
    out = {}
    for c in ALL:
        if c.duck_sql is SAME:
            out[c.name] = c.spark_sql
        elif c.duck_sql is not None:
            out[c.name] = c.duck_sql
    out.update(SPLIT_ORACLES)
    out.update({name: sql for name, (_, sql) in EXTRA.items() if sql is not None})
    return out
