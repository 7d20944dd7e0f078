"""The library's own operators as queries over the driver tables.

Each builder takes ``(spark, sf_dir)``, lays its input datasets down in a
fresh folder under the shared workspace (``spark.checkpoint.dir``), runs the
load it exercises, and returns the target dataset read back through the
upload log, so the whole path (stringify -> CSV write -> log -> read) is in
the checked result. ``LOAD_ORACLES`` holds the DuckDB text for the same
answer, computed straight from the parquet tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import split_percentile
from ..operators.result import preview, stringify
from ..operators.sql import register, run_sql
from ..session import ensure_database, scratch_dir, sql_literal
from ..sources.catalog import publish
from ..sources.csv_contract import WRITE_OPTIONS
from ..sources.datasets import DatasetRef, Lake, read_dataset, read_result_csv
from ..sources.sketches import summaries
from ..sources.stored import latest_per_name, put_queries, put_query, stored_queries, stored_query_index
from ..sources.upload_log import append_row
from ..sources.uploads import append, reload
from .inputs import table
from .jobs import load_sql, load_stored

EPOCH0 = 1_700_000_000
USER = "etluser"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def _lake(spark: SparkSession, tag: str) -> Lake:
    return Lake(scratch_dir(spark, tag))


def load_sql_frame(spark: SparkSession, lake: Lake, mapping, query: str) -> DataFrame:
    """The result a load would write, before the write (what a preview shows)."""
    register(spark, mapping, lake)
    return run_sql(spark, query)


# -- A1 A3 A4 A9 A14 A19: the mapped-datasets job with the UNION ALL text ----

# The original job's inputs, its SQL text and the two aliases.
UNION_ALL_QUERY = """
    SELECT * FROM dataset_name_1
    UNION ALL
    SELECT * FROM dataset_name_2
"""


def load_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark, "union")
    one, two = DatasetRef("domain_1", "DatasetName1"), DatasetRef("domain_2", "DatasetName2")
    cust = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    supp = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    append(spark, cust, lake, one, USER, epoch=EPOCH0)
    append(spark, supp, lake, two, USER, epoch=EPOCH0)
    target = DatasetRef("output_domain", "output_dataset")
    load_sql(spark, lake, {"dataset_name_1": one, "dataset_name_2": two}, UNION_ALL_QUERY, target, USER, epoch=EPOCH0 + 10)
    return read_dataset(spark, lake, target)


# -- A1 A2 A8 A9: round trips --------------------------------------------------


def _roundtrip(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    lake = _lake(spark, f"rt-{table}")
    ref = DatasetRef("rt", table)
    append(spark, _table(spark, sf_dir, table), lake, ref, USER, epoch=EPOCH0)
    return read_dataset(spark, lake, ref)


def dataset_roundtrip_customer(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "customer")


def dataset_roundtrip_documents(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "documents")


def dataset_roundtrip_events(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "events")


def dataset_roundtrip_embeddings(spark, sf_dir):
    """The JSON text of each vector parsed again: every component exact."""
    back = _roundtrip(spark, sf_dir, "embeddings")
    return back.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.from_json("embedding", "array<float>").alias("embedding"),
        F.col("label").cast("int").alias("label"),
    )


def dataset_roundtrip_pages(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "pages")


def dataset_roundtrip_conversations(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "conversations")


def result_csv_scan(spark, sf_dir):
    """A2: a headed CSV answer file as another engine leaves it (text values,
    header, doubled quotes), read back as all-string columns."""
    path = f"{scratch_dir(spark, 'result')}/query-0001.csv"
    stringify(_table(spark, sf_dir, "orders")).write.options(header="true", escape='"').csv(path)
    return read_result_csv(spark, path)


def nested_text_roundtrip(spark, sf_dir):
    """A8: structs with null fields and arrays of microsecond timestamps, as
    the text that a load writes."""
    lake, ref = _lake(spark, "nested"), DatasetRef("rt", "nested")
    nested = _table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(F.lit(None).cast("string").alias("nothing"), F.col("event_type").alias("kind"), F.col("ts").alias("at")).alias("s"),
        F.array("ts", F.lit(None).cast("timestamp_ntz")).alias("times"),
    )
    append(spark, nested, lake, ref, USER, epoch=EPOCH0)
    return read_dataset(spark, lake, ref)


def _laid_down(spark, sf_dir, base: str) -> None:
    """``orders`` as other writers leave it: several upload folders, one file
    compressed, no log."""
    text = stringify(_table(spark, sf_dir, "orders"))
    for epoch, status, options in ((EPOCH0, "F", {}), (EPOCH0 + 1, "O", {"compression": "gzip"}), (EPOCH0 + 2, "P", {})):
        part = text.filter(F.col("o_orderstatus") == status)
        part.write.options(**WRITE_OPTIONS, **options).csv(f"{base}/upload_date={epoch}/other/csv")


def unlogged_dataset_all_files(spark, sf_dir):
    lake, ref = _lake(spark, "unlogged"), DatasetRef("sales", "orders")
    _laid_down(spark, sf_dir, lake.dataset_dir(ref))
    return read_dataset(spark, lake, ref)


def load_union_all_unlogged(spark, sf_dir):
    """Datasets that another writer made, mapped by name in the
    ``{domain, dataset}`` form, and loaded."""
    lake, ref = _lake(spark, "unionunlogged"), DatasetRef("sales", "orders")
    _laid_down(spark, sf_dir, lake.dataset_dir(ref))
    target = DatasetRef("output_domain", "output_dataset")
    mapping = {"dataset_name_1": {"domain": "sales", "dataset": "orders"}, "dataset_name_2": "sales:orders"}
    load_sql(spark, lake, mapping, UNION_ALL_QUERY, target, USER, epoch=EPOCH0 + 10)
    return read_dataset(spark, lake, target)


def mapped_parquet_dataset(spark, sf_dir):
    """An ordinary parquet folder as a mapped dataset: its types stay."""
    lake, ref = _lake(spark, "mappedparquet"), DatasetRef("sales", "orders_parquet")
    _table(spark, sf_dir, "orders").write.parquet(lake.dataset_dir(ref))
    return load_sql_frame(spark, lake, {"o": ref}, "SELECT o_orderkey, o_totalprice, o_orderdate FROM o WHERE o_totalprice > 1000")


def publish_two_users_one_epoch(spark, sf_dir):
    """Two users' uploads of one second (the layout allows it; the loads raced):
    the published table has both."""
    lake, ref = _lake(spark, "twousers"), DatasetRef("domain", "twousers")
    orders = _table(spark, sf_dir, "orders")
    first = append(spark, orders.filter("o_orderstatus = 'F'"), lake, ref, "one", epoch=EPOCH0)
    text = stringify(orders.filter("o_orderstatus <> 'F'"))
    text.write.options(**WRITE_OPTIONS).csv(lake.upload_dir(ref, EPOCH0, "two"))
    append_row(spark, lake.log_dir(ref), {
        "domain": ref.domain, "dataset": ref.dataset, "upload_date": EPOCH0, "user_id": "two", "mode": "append",
        "rows": first.rows, "columns": text.columns, "format": "csv",
    })
    publish(spark, lake, ref)
    return run_sql(spark, "SELECT * FROM domain.twousers").drop("upload_date")


def stored_query_long_epoch(spark, sf_dir):
    """Epochs in nanoseconds (19 digits): the later of two texts of a name wins."""
    epoch = F.lit(1_700_000_000_000_000_000) + F.col("o_orderkey")
    base = f"{scratch_dir(spark, 'stored')}/store"
    put_queries(
        _table(spark, sf_dir, "orders").select(
            F.lit("u").alias("user"), F.lit("d").alias("dataset_id"), epoch.alias("epoch"),
            F.concat(F.lit("report_"), F.col("o_custkey").cast("string"), F.lit(".sql")).alias("file_name"),
            F.concat(F.lit("SELECT "), epoch.cast("string")).alias("text"),
        ),
        base,
    )
    return latest_per_name(stored_queries(spark, base)).select("file_name", "upload_epoch", "text")


# -- A9 A10 A11 A12: append / reload / guard -----------------------------------


def append_twice(spark, sf_dir):
    lake, ref = _lake(spark, "append2"), DatasetRef("sales", "orders")
    orders = _table(spark, sf_dir, "orders")
    append(spark, orders.filter("o_orderstatus = 'F'"), lake, ref, USER, epoch=EPOCH0)
    append(spark, orders.filter("o_orderstatus <> 'F'"), lake, ref, USER, epoch=EPOCH0 + 1)
    return read_dataset(spark, lake, ref)


def mixed_format_uploads(spark, sf_dir):
    """One dataset, a CSV upload and a parquet upload (all-string columns in
    both): read back as one frame."""
    lake, ref = _lake(spark, "mixed"), DatasetRef("sales", "orders")
    orders = _table(spark, sf_dir, "orders")
    append(spark, orders.filter("o_orderstatus = 'F'"), lake, ref, USER, epoch=EPOCH0)
    append(spark, orders.filter("o_orderstatus <> 'F'"), lake, ref, USER, epoch=EPOCH0 + 1, file_format="parquet")
    return read_dataset(spark, lake, ref)


def reload_then_append(spark, sf_dir):
    lake, ref = _lake(spark, "reload"), DatasetRef("sales", "orders")
    orders = _table(spark, sf_dir, "orders")
    append(spark, orders.filter("o_orderstatus = 'F'"), lake, ref, USER, epoch=EPOCH0)
    reload(spark, orders.filter("o_orderstatus = 'O'"), lake, ref, USER, epoch=EPOCH0 + 1)
    append(spark, orders.filter("o_orderstatus = 'P'"), lake, ref, USER, epoch=EPOCH0 + 2)
    return read_dataset(spark, lake, ref)


def reload_from_itself(spark, sf_dir):
    lake, ref = _lake(spark, "selfreload"), DatasetRef("sales", "orders")
    append(spark, _table(spark, sf_dir, "orders"), lake, ref, USER, epoch=EPOCH0)
    load_sql(
        spark,
        lake,
        {"orders_ds": ref},
        "SELECT * FROM orders_ds WHERE o_orderpriority = '1-URGENT'",
        ref,
        USER,
        reload=True,
        epoch=EPOCH0 + 1,
    )
    return read_dataset(spark, lake, ref)


def skip_empty(spark, sf_dir):
    lake, ref = _lake(spark, "skipempty"), DatasetRef("ops", "returns")
    items = _table(spark, sf_dir, "lineitem")
    append(spark, items, lake, ref, USER, epoch=EPOCH0)
    result = load_sql(
        spark, lake, {"li": items}, "SELECT * FROM li WHERE l_quantity < 0", ref, USER, epoch=EPOCH0 + 1
    )
    assert result.skipped and result.rows == 0, result
    return read_dataset(spark, lake, ref)


# -- A20 A21 A22: qualified names, comment and terminator, LIMIT ---------------


def qualified_scan(spark, sf_dir):
    """``-- Sample Query`` / ``select * from rawtest.<t>_parquet;`` over a
    catalog table declared on the given parquet file."""
    ensure_database(spark, "rawtest")
    spark.sql("DROP TABLE IF EXISTS rawtest.orders_parquet")
    spark.sql(f"CREATE TABLE rawtest.orders_parquet USING parquet LOCATION {sql_literal(sf_dir + '/orders.parquet')}")
    return run_sql(spark, "-- Sample Query\nselect * from rawtest.orders_parquet;")


def publish_mixed(spark, sf_dir):
    """A21: a dataset of CSV and parquet uploads by its qualified name; a filter
    on ``upload_date`` leaves uploads of both formats unread."""
    lake, ref = _lake(spark, "publishmixed"), DatasetRef("mixed_domain", "orders")
    orders = _table(spark, sf_dir, "orders")
    for i, (status, fmt) in enumerate((("F", "csv"), ("O", "parquet"), ("P", "csv"))):
        append(spark, orders.filter(F.col("o_orderstatus") == status), lake, ref, USER, epoch=EPOCH0 + i, file_format=fmt)
    publish(spark, lake, ref)
    return run_sql(spark, f"SELECT * FROM mixed_domain.orders WHERE upload_date >= {EPOCH0 + 1}")


def publish_typed(spark, sf_dir):
    """A21: ``select * from domain.dataset`` with the types of its uploads."""
    lake, ref = _lake(spark, "publishtyped"), DatasetRef("typed_domain", "orders")
    orders = _table(spark, sf_dir, "orders")
    append(spark, orders.filter("o_orderstatus = 'F'"), lake, ref, USER, epoch=EPOCH0, file_format="parquet", typed=True)
    append(spark, orders.filter("o_orderstatus <> 'F'"), lake, ref, "other", epoch=EPOCH0 + 1, file_format="parquet", typed=True)
    publish(spark, lake, ref)
    return run_sql(spark, "SELECT * FROM typed_domain.orders WHERE o_totalprice > 100000")


def publish_unlogged(spark, sf_dir):
    """A21: the files of other writers by a qualified name, CSV (one upload
    compressed) and parquet; a filter on ``upload_date`` prunes."""
    lake, ref = _lake(spark, "publishunlogged"), DatasetRef("rawtest", "orders_laid_down")
    base = lake.dataset_dir(ref)
    _laid_down(spark, sf_dir, base)
    stringify(_table(spark, sf_dir, "orders").filter("o_totalprice < 50000")).write.parquet(f"{base}/upload_date={EPOCH0 + 3}/more/parquet")
    publish(spark, lake, ref)
    return run_sql(spark, f"-- Sample Query\nselect * from rawtest.orders_laid_down where upload_date <> {EPOCH0};").drop("upload_folder")


def typed_uploads(spark, sf_dir):
    """A1 A9: uploads that keep their types, read together and filtered."""
    lake, ref = _lake(spark, "typed"), DatasetRef("sales", "lines_typed")
    lines = _table(spark, sf_dir, "lineitem")
    append(spark, lines.filter("l_returnflag = 'N'").withColumn("l_linenumber", F.col("l_linenumber").cast("smallint")), lake, ref, USER, epoch=EPOCH0, file_format="parquet", typed=True)
    append(spark, lines.filter("l_returnflag <> 'N'"), lake, ref, USER, epoch=EPOCH0 + 1, file_format="parquet", typed=True)
    return read_dataset(spark, lake, ref).where("l_quantity > 30 and l_linenumber < 4")


def sketched_uploads(spark, sf_dir):
    """Distinct counts and medians over three uploads from the sketches kept with
    them, held against the exact ones."""
    lake, ref = _lake(spark, "sketched"), DatasetRef("sales", "lines_sketched")
    lines, columns = _table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_extendedprice", "l_shipdate"]
    for i, flag in enumerate("ANR"):
        append(spark, lines.filter(F.col("l_returnflag") == flag), lake, ref, USER, epoch=EPOCH0 + i, file_format="parquet", typed=True, sketch=columns)
    near = summaries(spark, lake, ref, columns, [0.5])
    # each exact count by itself: together they would make every row once for each
    exact = reduce(DataFrame.unionByName, [lines.agg(F.count_distinct(c).alias("exact")).select(F.lit(c).alias("c"), "exact") for c in columns])
    rows = exact.crossJoin(split_percentile(lines, "l_extendedprice", 0.5).select(F.col("value").alias("median")))
    return near.join(rows, F.col("column") == F.col("c")).select(
        "column", (F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.08 * F.col("exact")).alias("distinct_near"),
        F.when(F.col("column") == "l_extendedprice", F.abs(F.col("quantiles")[0] - F.col("median")) <= 0.02 * F.col("median")).alias("median_near"),
    )


def limit_ordered(spark, sf_dir):
    """``select * from domain.dataset ... LIMIT 10;`` on a published dataset,
    with an order so the ten rows are defined."""
    lake, ref = _lake(spark, "limit"), DatasetRef("domain", "dataset")
    append(spark, _table(spark, sf_dir, "orders"), lake, ref, USER, epoch=EPOCH0)
    publish(spark, lake, ref)
    return run_sql(
        spark,
        "select * from domain.dataset "
        "order by cast(o_totalprice as double) desc, cast(o_orderkey as bigint) LIMIT 10;",
    )


def limit_any_ten(spark, sf_dir):
    """The inline text exactly as users write it, without an order: any ten
    rows of the table are a right answer, and that is what is checked."""
    lake, ref = _lake(spark, "limit10"), DatasetRef("domain", "dataset")
    append(spark, _table(spark, sf_dir, "orders"), lake, ref, USER, epoch=EPOCH0)
    publish(spark, lake, ref)
    ten = run_sql(spark, "select * from domain.dataset LIMIT 10;").drop("upload_date", "upload_user")
    whole = stringify(_table(spark, sf_dir, "orders"))
    return ten.join(whole, ten.columns, "left_semi").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_orderkey").alias("n_keys")
    )


def preview_result(spark, sf_dir):
    """A13: the first rows of a load's result as the preview shows them; the
    text orders its result so the twenty rows are defined."""
    lake, ref = _lake(spark, "preview"), DatasetRef("sales", "orders")
    append(spark, _table(spark, sf_dir, "orders"), lake, ref, USER, epoch=EPOCH0)
    result = load_sql_frame(
        spark, lake, {"o": ref},
        "SELECT o_orderkey, o_orderpriority FROM o ORDER BY CAST(o_totalprice AS DOUBLE) DESC, o_orderkey",
    )
    return preview(result, 20)


def qualified_dataset_pruned(spark, sf_dir):
    """Three uploads, one reload: the catalog table holds only the visible
    uploads, and a filter on ``upload_date`` prunes partitions."""
    lake, ref = _lake(spark, "pruned"), DatasetRef("domain", "lines")
    items = _table(spark, sf_dir, "lineitem")
    append(spark, items.filter("l_linestatus = 'F'"), lake, ref, USER, epoch=EPOCH0)
    reload(spark, items.filter("l_returnflag = 'N'"), lake, ref, USER, epoch=EPOCH0 + 1)
    append(spark, items.filter("l_returnflag = 'A'"), lake, ref, USER, epoch=EPOCH0 + 2)
    publish(spark, lake, ref)
    return run_sql(
        spark,
        "SELECT l_returnflag, l_linestatus, count(*) AS n_lines, "
        "sum(CAST(l_quantity AS DECIMAL(18,2))) AS sum_qty "
        f"FROM domain.lines WHERE upload_date > {EPOCH0 + 1} GROUP BY l_returnflag, l_linestatus",
    )


# -- A5 A15: stored queries ----------------------------------------------------


def _stored_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of one stored query per order, named
    ``u<custkey>_d<orderkey>_<epoch>_cust_<custkey>_orders.sql``: every
    customer's report name is uploaded once per order of theirs."""
    o = _table(spark, sf_dir, "orders")
    base = f"{scratch_dir(spark, 'stored')}/sqlstore/reports"
    text = F.concat(F.lit("-- report\nSELECT * FROM orders WHERE o_orderkey = "), F.col("o_orderkey").cast("string"), F.lit(";"))
    put_queries(
        o.select(
            F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("user"), F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("dataset_id"),
            (F.lit(1_600_000_000) + F.col("o_orderkey")).alias("epoch"),
            F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"), F.lit("_orders.sql")).alias("file_name"), text.alias("text"),
        ),
        base,
    )
    return base


def _below(path: Column) -> Column:
    """A listed path without the scratch folder it is in."""
    return F.concat(F.lit("sqlstore/reports/"), F.substring_index(path, "/", -1))


def stored_query_keys(spark, sf_dir):
    """A5: the listing of a folder of files, by their names alone."""
    return stored_query_index(spark, _stored_files(spark, sf_dir)).withColumn("path", _below(F.col("path")))


def stored_query_latest(spark, sf_dir):
    """A5: every file read, the newest upload of each name."""
    return latest_per_name(stored_queries(spark, _stored_files(spark, sf_dir)).withColumn("path", _below(F.col("path"))))


STORED_REPORT_OLD = "-- Sample Query\nselect o_orderpriority from orders_v;"
STORED_REPORT = """-- Sample Query
SELECT o_orderpriority,
       count(*) AS n_orders,
       sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_price
FROM orders_v
GROUP BY o_orderpriority;
"""


def load_stored_query(spark, sf_dir):
    """Two uploads of one stored name (the later wins) -> Spark SQL over the
    mapped ``orders`` table -> append into the target -> read back."""
    lake = _lake(spark, "stored")
    sql_ds, target = DatasetRef("sql_domain", "sql_dataset"), DatasetRef("out", "priorities")
    put_query(spark, lake, sql_ds, USER, "ds1", EPOCH0, "priority_report.sql", STORED_REPORT_OLD)
    put_query(spark, lake, sql_ds, USER, "ds1", EPOCH0 + 5, "priority_report.sql", STORED_REPORT)
    load_stored(
        spark, lake, sql_ds, "priority_report.sql", target, USER,
        mapping={"orders_v": _table(spark, sf_dir, "orders")}, epoch=EPOCH0 + 10,
    )
    return read_dataset(spark, lake, target)


LOAD_QUERIES = {
    "load_union_all": load_union_all,
    "dataset_roundtrip_customer": dataset_roundtrip_customer,
    "dataset_roundtrip_documents": dataset_roundtrip_documents,
    "dataset_roundtrip_events": dataset_roundtrip_events,
    "dataset_roundtrip_embeddings": dataset_roundtrip_embeddings,
    "dataset_roundtrip_pages": dataset_roundtrip_pages,
    "dataset_roundtrip_conversations": dataset_roundtrip_conversations,
    "result_csv_scan": result_csv_scan,
    "nested_text_roundtrip": nested_text_roundtrip,
    "unlogged_dataset_all_files": unlogged_dataset_all_files,
    "load_union_all_unlogged": load_union_all_unlogged,
    "mapped_parquet_dataset": mapped_parquet_dataset,
    "publish_two_users_one_epoch": publish_two_users_one_epoch,
    "stored_query_long_epoch": stored_query_long_epoch,
    "append_twice": append_twice,
    "mixed_format_uploads": mixed_format_uploads,
    "reload_then_append": reload_then_append,
    "reload_from_itself": reload_from_itself,
    "skip_empty": skip_empty,
    "qualified_scan": qualified_scan,
    "limit_ordered": limit_ordered,
    "publish_mixed": publish_mixed,
    "publish_typed": publish_typed,
    "publish_unlogged": publish_unlogged,
    "typed_uploads": typed_uploads,
    "sketched_uploads": sketched_uploads,
    "limit_any_ten": limit_any_ten,
    "preview_result": preview_result,
    "qualified_dataset_pruned": qualified_dataset_pruned,
    "stored_query_keys": stored_query_keys,
    "stored_query_latest": stored_query_latest,
    "load_stored_query": load_stored_query,
}

_ORDERS_TEXT = """CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority"""

_KEY_FIELDS = """
  WITH k AS (
    SELECT 'sqlstore/reports/u' || CAST(o_custkey AS VARCHAR) || '_d' || CAST(o_orderkey AS VARCHAR)
           || '_' || CAST(1600000000 + o_orderkey AS VARCHAR) || '_cust_' || CAST(o_custkey AS VARCHAR)
           || '_orders.sql' AS path,
           '-- report' || chr(10) || 'SELECT * FROM orders WHERE o_orderkey = ' || CAST(o_orderkey AS VARCHAR) || ';' AS text
    FROM orders),
  p AS (SELECT path, text, string_split(string_split(path, '/')[-1], '_') AS parts FROM k)
  SELECT path, parts[1] AS user_id, parts[2] AS dataset_id, CASE WHEN regexp_full_match(parts[3], '[0-9]+') THEN TRY_CAST(parts[3] AS BIGINT) END AS upload_epoch,
         array_to_string(parts[4:], '_') AS file_name, text
  FROM p"""

LOAD_ORACLES = {
    "load_union_all": """
        SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
        UNION ALL
        SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR) FROM supplier""",
    "dataset_roundtrip_customer": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer""",
    "dataset_roundtrip_documents": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
        FROM documents""",
    "dataset_roundtrip_embeddings": "SELECT vec_id, embedding, label FROM embeddings",
    "dataset_roundtrip_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS user_id,
               event_type, CAST(value AS VARCHAR) AS value, props FROM events""",
    "dataset_roundtrip_pages": "SELECT CAST(page_id AS VARCHAR) AS page_id, url, html FROM pages",
    "dataset_roundtrip_conversations": """
        SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, text FROM conversations""",
    "append_twice": f"""
        SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus <> 'F'""",
    "mixed_format_uploads": f"""
        SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus = 'F'
        UNION ALL
        SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus <> 'F'""",
    "reload_then_append": f"""
        SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus = 'O'
        UNION ALL
        SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderstatus = 'P'""",
    "reload_from_itself": f"SELECT {_ORDERS_TEXT} FROM orders WHERE o_orderpriority = '1-URGENT'",
    "result_csv_scan": f"SELECT {_ORDERS_TEXT} FROM orders",
    "nested_text_roundtrip": """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               '{"nothing":null,"kind":"' || event_type || '","at":"' || CAST(ts AS VARCHAR) || '"}' AS s,
               '["' || CAST(ts AS VARCHAR) || '",null]' AS times
        FROM events""",
    "unlogged_dataset_all_files": f"SELECT {_ORDERS_TEXT} FROM orders",
    "load_union_all_unlogged": f"SELECT {_ORDERS_TEXT} FROM orders UNION ALL SELECT {_ORDERS_TEXT} FROM orders",
    "mapped_parquet_dataset": "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice > 1000",
    "publish_two_users_one_epoch": f"""
        SELECT {_ORDERS_TEXT}, CASE WHEN o_orderstatus = 'F' THEN 'one' ELSE 'two' END AS upload_user FROM orders""",
    "stored_query_long_epoch": """
        SELECT 'report_' || CAST(o_custkey AS VARCHAR) || '.sql' AS file_name,
               1700000000000000000 + max(o_orderkey) AS upload_epoch,
               'SELECT ' || CAST(1700000000000000000 + max(o_orderkey) AS VARCHAR) AS text
        FROM orders GROUP BY o_custkey""",
    "skip_empty": """
        SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
               CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
               CAST(l_quantity AS VARCHAR) AS l_quantity, CAST(l_extendedprice AS VARCHAR) AS l_extendedprice,
               CAST(l_discount AS VARCHAR) AS l_discount, CAST(l_tax AS VARCHAR) AS l_tax,
               l_returnflag, l_linestatus, CAST(l_shipdate AS VARCHAR) AS l_shipdate
        FROM lineitem""",
    "qualified_scan": "SELECT * FROM orders",
    "publish_mixed": f"""
        SELECT {_ORDERS_TEXT}, CAST(CASE WHEN o_orderstatus = 'O' THEN 1700000001 ELSE 1700000002 END AS BIGINT) AS upload_date, 'etluser' AS upload_user
        FROM orders WHERE o_orderstatus <> 'F'""",
    "publish_typed": """
        SELECT *, CAST(CASE WHEN o_orderstatus = 'F' THEN 1700000000 ELSE 1700000001 END AS BIGINT) AS upload_date,
               CASE WHEN o_orderstatus = 'F' THEN 'etluser' ELSE 'other' END AS upload_user
        FROM orders WHERE o_totalprice > 100000""",
    "publish_unlogged": f"""
        SELECT {_ORDERS_TEXT}, CAST(CASE WHEN o_orderstatus = 'O' THEN 1700000001 ELSE 1700000002 END AS BIGINT) AS upload_date
        FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT {_ORDERS_TEXT}, CAST(1700000003 AS BIGINT) FROM orders WHERE o_totalprice < 50000""",
    "typed_uploads": "SELECT * FROM lineitem WHERE l_quantity > 30 AND l_linenumber < 4",
    "sketched_uploads": """
        SELECT 'l_orderkey' AS "column", true AS distinct_near, CAST(NULL AS BOOLEAN) AS median_near FROM (SELECT count(*) FROM lineitem) t
        UNION ALL SELECT 'l_extendedprice', true, true FROM (SELECT count(*) FROM lineitem) t
        UNION ALL SELECT 'l_shipdate', true, NULL FROM (SELECT count(*) FROM lineitem) t""",
    "limit_ordered": f"""
        SELECT {_ORDERS_TEXT}, CAST(1700000000 AS BIGINT) AS upload_date, 'etluser' AS upload_user
        FROM orders ORDER BY orders.o_totalprice DESC, orders.o_orderkey LIMIT 10""",
    "limit_any_ten": "SELECT CAST(10 AS BIGINT) AS n_rows, CAST(10 AS BIGINT) AS n_keys FROM (SELECT count(*) FROM orders) t",
    "preview_result": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority
        FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
    "qualified_dataset_pruned": """
        SELECT l_returnflag, l_linestatus, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sum_qty
        FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_returnflag, l_linestatus""",
    "stored_query_keys": f"SELECT path, user_id, dataset_id, upload_epoch, file_name FROM ({_KEY_FIELDS}) f",
    "stored_query_latest": f"""
        SELECT file_name, arg_max(path, upload_epoch) AS path, arg_max(user_id, upload_epoch) AS user_id,
               arg_max(dataset_id, upload_epoch) AS dataset_id, max(upload_epoch) AS upload_epoch,
               arg_max(text, upload_epoch) AS text
        FROM ({_KEY_FIELDS}) f GROUP BY file_name""",
    "load_stored_query": """
        SELECT o_orderpriority, CAST(count(*) AS VARCHAR) AS n_orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS total_price
        FROM orders GROUP BY o_orderpriority""",
}
