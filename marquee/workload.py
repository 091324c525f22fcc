"""Every operator as a query over the shared test tables, with the SQL that gives the same rows.

The tables play the library's roles: parts and orders are catalogues, documents hold the texts,
labels and line items are supplements, events are reviews. Derived doubles are rounded on both
sides because engines add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import (
    decade_of,
    parse_date,
    rating_gap,
    strip_unit,
    to_double,
)
from marquee.operators import (
    agg_distinct,
    agg_exact_mean,
    agg_first,
    agg_mean,
    agg_stddev,
    assemble_features,
    cleaning_report,
    counted_terms,
    daily_average,
    dedup_by_key,
    dedup_rows,
    drop_missing,
    enrich_left,
    explode_tags,
    feature_importance,
    fill_missing,
    fit_regressor,
    encode_by_label,
    fit_topic_table,
    fit_vocabulary,
    index_category,
    low_rated_absolute,
    low_rated_relative,
    one_hot,
    predict,
    r2_score,
    remove_stopwords,
    split_train_test,
    term_counts,
    term_vectors,
    tokenize,
    top_n,
    topic_shares,
    vector_entries,
)
from marquee.plans import (
    absolute_alerts,
    daily_ratings,
    decade_trends,
    prepare_revenue_rows,
    relative_alerts,
    revenue_model,
    revenue_report,
    tag_ratings,
)
from marquee.schemas import CatalogueColumns, ReviewColumns, SupplementColumns
from marquee.session import materialise, scratch_dir, stages
from marquee.sources import (
    decode_messages,
    ingest_csv,
    parse_json_messages,
    preview_table,
    publish_json,
    read_json_objects,
    read_offset_range,
    read_partition,
    scan_csv,
    scan_table,
    stream_source,
    write_table,
)
from marquee.streaming import merge_each_batch, read_merged, low_rated_stream, overwrite_each_batch, publish_each_batch, read_published

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL unless the result cannot be fixed in SQL."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan_table(spark, f"{sf_dir}/{name}.parquet", "parquet")


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- the tables in their roles -------------------------------------------------------------------

PARTS = CatalogueColumns(title="Series_Title", rating="Rating")


def part_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a raw catalogue: unit texts, tag lists, and values that are missing or unusable."""
    size, price = F.col("p_size"), F.col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_name").alias("Series_Title"),
        F.when(F.col("p_type") != "PROMO", F.replace("p_name", F.lit(" "), F.lit(", "))).alias("Genre"),
        F.when(size == 11, F.lit("n/a")).otherwise(F.concat(size, F.lit(" min"))).alias("Runtime"),
        F.when(size != 12, price).alias("Rating"),
        F.when(size > 40, F.lit("28,341")).otherwise(price.cast("string")).alias("Gross"),
    )


PART_CATALOGUE_SQL = """parts AS (
    SELECT p_partkey, p_name AS title,
           CASE WHEN p_type <> 'PROMO' THEN replace(p_name, ' ', ', ') END AS tags,
           CASE WHEN p_size <> 11 THEN p_size END AS runtime,
           CASE WHEN p_size <> 12 THEN p_retailprice END AS rating,
           CASE WHEN p_size <= 40 THEN p_retailprice END AS gross
    FROM part)"""

ORDERS = CatalogueColumns(title="o_custkey", year="Released_Year", rating="o_totalprice")


def order_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.year("o_orderdate").cast("string").alias("Released_Year"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "P", F.lit("min"))
        .otherwise(F.concat(F.dayofmonth("o_orderdate") + 60, F.lit(" min")))
        .alias("Runtime"),
    )


EVENTS = ReviewColumns("event_id", "user_id", "day", "value", "overall")


def event_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.to_date("ts").alias("day")
    )


def with_overall(reviews: DataFrame) -> DataFrame:
    """Add each user's mean over all events. Users differ a lot in activity, so this is a join of
    reduced rows rather than a window over a user's rows."""
    overall = reviews.groupBy("user_id").agg(agg_exact_mean("value", "overall"))
    return enrich_left(reviews, overall, "user_id", unique=True)


EVENT_MESSAGE = "event_id bigint, user_id bigint, value double, day string"
EVENT_MESSAGE_WITH_OVERALL = EVENT_MESSAGE + ", overall double"


def wire_form(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("day", F.date_format("day", "M/d/yyyy"))


def event_messages(reviews: DataFrame) -> DataFrame:
    return wire_form(reviews).select(F.to_json(F.struct("*")).cast("binary").alias("value"))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a message log with one partition per hour of the day; clicks have no key."""
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "click", F.col("event_type")).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.hour("ts").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


DOCUMENTS = CatalogueColumns(
    title="doc_id",
    year="n_chars",
    runtime="Runtime",
    tags="lang",
    rating="Rating",
    overview="text",
    creator="source",
    gross="Gross",
)
DOCUMENT_LABELS = SupplementColumns(location="grade", numeric=("quality", "toxic"))


def document_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.size(F.split("text", " "))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        "n_chars",
        "lang",
        F.when(F.col("source") != "src3", F.col("source")).alias("source"),
        F.concat(words, F.lit(" min")).alias("Runtime"),
        (F.col("n_chars") / words).alias("Rating"),
        F.when(F.col("lang") == "de", F.lit("n/a"))
        .otherwise(F.col("n_chars").cast("string"))
        .alias("Gross"),
    )


def label_supplement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").withColumn(
        "grade", F.when(F.col("quality") == 1, "good").otherwise("poor")
    )


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with their first line item as a supplement."""
    parts = table(spark, sf_dir, "part")
    return enrich_left(
        parts, line_supplement(spark, sf_dir), "p_partkey", LINE_ORDER, broadcast_bytes=0
    )


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]


def line_supplement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), *LINE_ORDER)


LINE_SUPPLEMENT_SQL = """supplement AS (
    SELECT * FROM (
        SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
               row_number() OVER (PARTITION BY l_partkey
                   ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS rn
        FROM lineitem)
    WHERE rn = 1)"""


# --- scans, sources, sinks -----------------------------------------------------------------------


@query("scan_table", "SELECT * FROM orders")
def _scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


@query(
    "scan_csv",
    """SELECT CAST(p_partkey AS INT) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
       FROM part""",
)
def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    write_table(table(spark, sf_dir, "part"), path, "csv", header=True)
    return scan_csv(spark, path)


@query("ingest_csv", "SELECT * FROM customer")
def _ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_dir(spark, "csv")
    write_table(customer, path, "csv", header=True)
    return ingest_csv(spark, path, scratch_dir(spark, "table"), "parquet", schema=customer.schema)


@query("preview_table", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100")
def _preview_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_table(spark, table(spark, sf_dir, "orders"), 100, "o_orderkey")


@query("write_table", "SELECT * FROM lineitem")
def _write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "table")
    write_table(table(spark, sf_dir, "lineitem"), path, "parquet")
    return scan_table(spark, path, "parquet")


EVENT_LOG_SQL = """log AS (
    SELECT nullif(event_type, 'click') AS key, props AS value, 'events' AS topic,
           CAST(hour(ts) AS INT) AS "partition", event_id AS "offset", ts AS "timestamp" FROM events)"""
DECODED_SQL = "CASE WHEN key IS NULL THEN value ELSE concat(key, '   ', value) END AS display"


@query("decode_messages", f"WITH {EVENT_LOG_SQL} SELECT *, {DECODED_SQL} FROM log")
def _decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(event_log(spark, sf_dir))


@query("read_partition", f'WITH {EVENT_LOG_SQL} SELECT *, {DECODED_SQL} FROM log WHERE "partition" = 1')
def _read_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_messages(read_partition(event_log(spark, sf_dir), 1))


@query(
    "read_offset_range",
    f"""WITH {EVENT_LOG_SQL}, bound AS (
            SELECT max("offset") + 1 AS stop FROM log WHERE "partition" = 0)
        SELECT log.*, {DECODED_SQL} FROM log, bound
        WHERE "partition" = 0 AND "offset" >= stop // 2 AND "offset" < stop""",
)
def _read_offset_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later half of a partition, up to the end it has when the query starts."""
    log = event_log(spark, sf_dir)
    stop = read_partition(log, 0).agg(F.max("offset") + 1).first()[0]
    return decode_messages(read_offset_range(log, 0, stop // 2, stop))


@query("publish_json", "SELECT event_id, user_id, event_type, value, props FROM events")
def _publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    path = scratch_dir(spark, "topic")
    publish_json(rows, path)
    return parse_json_messages(scan_table(spark, path, "text"), rows.schema, None)


@query(
    "parse_json_messages",
    "SELECT event_id, user_id, value, CAST(ts AS DATE) AS day FROM events",
)
def _parse_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(event_reviews(spark, sf_dir))
    return parse_json_messages(messages, EVENT_MESSAGE, "day")


@query(
    "parse_json_fields",
    "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
)
def _parse_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_json_messages(event_log(spark, sf_dir), "k bigint", None)
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


# --- columns, filters, cleaning ------------------------------------------------------------------


@query("strip_unit", f"WITH {PART_CATALOGUE_SQL} SELECT p_partkey, runtime FROM parts")
def _strip_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_catalogue(spark, sf_dir).select("p_partkey", strip_unit("Runtime").alias("runtime"))


@query("to_double", f"WITH {PART_CATALOGUE_SQL} SELECT p_partkey, gross FROM parts")
def _to_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_catalogue(spark, sf_dir).select("p_partkey", to_double("Gross").alias("gross"))


@query(
    "fill_missing",
    f"""WITH {PART_CATALOGUE_SQL}
        SELECT p_partkey, coalesce(tags, 'unknown') AS tags, coalesce(rating, 0) AS rating FROM parts""",
)
def _fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_catalogue(spark, sf_dir).selectExpr("p_partkey", "Genre AS tags", "Rating AS rating")
    return fill_missing(rows, {"tags": "unknown", "rating": 0})


@query(
    "drop_missing",
    f"""WITH {PART_CATALOGUE_SQL}
        SELECT p_partkey, tags, rating FROM parts WHERE tags IS NOT NULL AND rating IS NOT NULL""",
)
def _drop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_catalogue(spark, sf_dir).selectExpr("p_partkey", "Genre AS tags", "Rating AS rating")
    return drop_missing(rows, ["tags", "rating"])


@query(
    "cleaning_report",
    f"""WITH {PART_CATALOGUE_SQL}
        SELECT count(*) AS rows_read,
               count(*) FILTER (tags IS NOT NULL AND rating IS NOT NULL) AS rows_after_first_drop,
               count(*) FILTER (tags IS NOT NULL AND rating IS NOT NULL AND runtime IS NOT NULL
                                AND gross IS NOT NULL) AS rows_after_second_drop
        FROM parts""",
)
def _cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning_report(
        part_catalogue(spark, sf_dir),
        ["Rating", "Gross", "Runtime", "Genre"],
        {"Runtime": strip_unit("Runtime"), "Gross": to_double("Gross")},
    )


@query(
    "decade_of",
    """SELECT o_orderkey, CAST(floor(year(o_orderdate) / 10) * 10 AS INT) AS start_year FROM orders""",
)
def _decade_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", decade_of(F.year("o_orderdate")).alias("start_year")
    )


@query("parse_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = wire_form(event_reviews(spark, sf_dir))
    return written.select("event_id", parse_date("day").alias("day"))


OVERALL_SQL = "o AS (SELECT user_id, avg(value) AS overall FROM events GROUP BY 1)"
DAILY_SQL = f"""{OVERALL_SQL}, d AS (
    SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS daily, min(overall) AS overall
    FROM events JOIN o USING (user_id) GROUP BY 1, 2)"""


@query(
    "rating_gap",
    f"""WITH {OVERALL_SQL} SELECT event_id, round(overall - value, 9) AS gap
        FROM events JOIN o USING (user_id)""",
)
def _rating_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = with_overall(event_reviews(spark, sf_dir))
    return reviews.select("event_id", rating_gap("overall", "value", 9).alias("gap"))


@query(
    "low_rated_absolute",
    f"""WITH {DAILY_SQL} SELECT user_id, day, round(daily, 9) AS "Daily_Average_Rating"
        FROM d WHERE daily < 10""",
)
def _low_rated_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = absolute_alerts(event_messages(event_reviews(spark, sf_dir)), 10.0, EVENT_MESSAGE, EVENTS)
    return rounded(alerts, 9, "Daily_Average_Rating")


#: Digits to which a gap is rounded before its test: fine enough to keep the means of cents apart, coarse enough that two
#: doubles' binary noise does not put a gap of exactly 30 under it.
GAP_DIGITS = 12
RELATIVE_SQL = f"""WITH {DAILY_SQL}
    SELECT user_id, day, round(daily, 9) AS "Daily_Average_Rating", round(overall, 9) AS overall,
           round(overall - daily, 9) AS "Rating_Difference"
    FROM d WHERE overall - daily >= 30"""


@query("low_rated_relative", RELATIVE_SQL)
def _low_rated_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(with_overall(event_reviews(spark, sf_dir)))
    alerts = relative_alerts(messages, 30.0, EVENT_MESSAGE_WITH_OVERALL, EVENTS, digits=GAP_DIGITS)
    return rounded(alerts, 9, "Daily_Average_Rating", "overall", "Rating_Difference")


# --- joins, duplicates, top-n --------------------------------------------------------------------


@query(
    "enrich_left",
    f"""WITH {LINE_SUPPLEMENT_SQL}
        SELECT p_partkey, p_brand, l_orderkey, l_linenumber, l_quantity, l_extendedprice
        FROM part LEFT JOIN supplement ON p_partkey = l_partkey""",
)
def _enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return enrich_left(
        parts, line_supplement(spark, sf_dir), "p_partkey", LINE_ORDER, broadcast_bytes=0
    )


@query(
    "enrich_left_measured",
    """SELECT o_orderkey, o_custkey, c_name, c_mktsegment
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def _enrich_left_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return enrich_left(orders, customers, "o_custkey")


@query(
    "dedup_by_key",
    """SELECT user_id, day, event_id, value FROM (
           SELECT user_id, CAST(ts AS DATE) AS day, event_id, value,
                  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS rn
           FROM events) WHERE rn = 1""",
)
def _dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_by_key(event_reviews(spark, sf_dir), ["user_id", "day"], ["event_id"])


@query("dedup_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def _dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return dedup_rows(lines.select("l_partkey", "l_suppkey", "l_returnflag"))


@query(
    "top_n",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20""",
)
def _top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_n(orders, 20, F.desc_nulls_last("o_totalprice"), "o_orderkey")


@query(
    "explode_tags",
    f"""WITH {PART_CATALOGUE_SQL}
        SELECT p_partkey, unnest(string_split(trim(tags), ', ')) AS tag FROM parts""",
)
def _explode_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_tags(part_catalogue(spark, sf_dir), "Genre", "tag").select("p_partkey", "tag")


# --- grouped measures ----------------------------------------------------------------------------


@query(
    "agg_mean",
    """SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) AS mean_price
       FROM lineitem GROUP BY 1, 2""",
)
def _agg_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus")
    return rounded(lines.agg(agg_mean("l_extendedprice", "mean_price")), 4, "mean_price")


@query(
    "agg_stddev",
    """SELECT o_custkey, round(stddev_samp(o_totalprice), 4) AS sd_price FROM orders GROUP BY 1""",
)
def _agg_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "orders").groupBy("o_custkey")
    return rounded(customers.agg(agg_stddev("o_totalprice", "sd_price")), 4, "sd_price")


@query(
    "agg_distinct",
    """SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1""",
)
def _agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_returnflag")
    return lines.agg(agg_distinct("l_partkey", "n_parts"))


@query(
    "agg_first",
    "SELECT user_id, arg_min(value, event_id) AS first_value FROM events GROUP BY 1",
)
def _agg_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").groupBy("user_id")
    return users.agg(agg_first("value", "event_id", "first_value"))


@query(
    "daily_average",
    f"""WITH {DAILY_SQL} SELECT user_id, day, round(daily, 9) AS "Daily_Average_Rating",
               round(overall, 9) AS overall FROM d""",
)
def _daily_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = with_overall(event_reviews(spark, sf_dir))
    daily = daily_average(reviews, EVENTS, with_overall=True, first_by="event_id")
    return rounded(daily, 9, "Daily_Average_Rating", "overall")


@query(
    "decade_trends",
    """WITH c AS (
           SELECT o_custkey, year(o_orderdate) AS y,
                  CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE o_totalprice END AS rating,
                  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE day(o_orderdate) + 60 END AS runtime
           FROM orders)
       SELECT CAST(floor(y / 10) * 10 AS INT) AS "Decade",
              round(avg(rating), 4) AS "Avg_o_totalprice",
              round(stddev_samp(rating), 4) AS "StdDev_o_totalprice",
              count(DISTINCT o_custkey) AS "Movies_Count",
              round(avg(runtime), 4) AS "Avg_Runtime",
              round(stddev_samp(runtime), 4) AS "StdDev_Runtime"
       FROM c GROUP BY 1""",
)
def _decade_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    trends = decade_trends(order_catalogue(spark, sf_dir), ORDERS)
    return rounded(trends, 4, *[c for c in trends.columns if c.startswith(("Avg", "StdDev"))])


@query(
    "tag_ratings",
    f"""WITH {PART_CATALOGUE_SQL}, tagged AS (
            SELECT *, unnest(string_split(trim(coalesce(tags, 'unknown')), ', ')) AS tag FROM parts),
        once AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tag, title ORDER BY p_partkey) AS rn
                           FROM tagged) WHERE rn = 1)
        SELECT tag AS "Individual_Genre",
               round(avg(coalesce(rating, 0)), 4) AS "Avg_Rating",
               round(stddev_samp(coalesce(rating, 0)), 4) AS "StdDev_Rating",
               count(DISTINCT title) AS "Movies_Count",
               round(avg(coalesce(runtime, 0)), 4) AS "Avg_Runtime",
               round(avg(coalesce(gross, 0)), 4) AS "Avg_Box_Office"
        FROM once GROUP BY 1""",
)
def _tag_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = tag_ratings(part_catalogue(spark, sf_dir), PARTS, ["p_partkey"])
    return rounded(ratings, 4, *[c for c in ratings.columns if c.startswith(("Avg", "StdDev"))])


# --- text ----------------------------------------------------------------------------------------

# Spark's English stop words, in Spark's order.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

WORDS_SQL = r"""words AS (
    SELECT doc_id, string_split_regex(lower(text), '\s') AS words FROM documents)"""
FILTERED_SQL = "{}, filtered AS (SELECT doc_id, list_filter(words, lambda w: w NOT IN ({})) AS words FROM words)".format(
    WORDS_SQL, ", ".join("'{}'".format(w.replace("'", "''")) for w in ENGLISH_STOP_WORDS)
)
WORD_DIGEST_SQL = "SELECT doc_id, CAST(len(words) AS INT) AS n, md5(array_to_string(words, ' ')) AS digest"


def words_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenize(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "words").drop(
        "text"
    )


def filtered_words_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_stopwords(words_of(spark, sf_dir), "words", "kept").select(
        "doc_id", F.col("kept").alias("words")
    )


def word_digest(words: DataFrame) -> DataFrame:
    return words.select(
        "doc_id", F.size("words").alias("n"), F.md5(F.array_join("words", " ")).alias("digest")
    )


@query("tokenize", f"WITH {WORDS_SQL} {WORD_DIGEST_SQL} FROM words")
def _tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_digest(words_of(spark, sf_dir))


@query("remove_stopwords", f"WITH {FILTERED_SQL} {WORD_DIGEST_SQL} FROM filtered")
def _remove_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_digest(filtered_words_of(spark, sf_dir))


@query(
    "term_counts",
    f"""WITH {FILTERED_SQL}
        SELECT term, count(*) AS n FROM (SELECT unnest(words) AS term FROM filtered) GROUP BY 1""",
)
def _term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_counts(filtered_words_of(spark, sf_dir), "words")


ENTRIES_SQL = f"""{FILTERED_SQL}, entries AS (
        SELECT doc_id, term, count(*) AS n
        FROM (SELECT doc_id, unnest(words) AS term FROM filtered) GROUP BY 1, 2),
    vocabulary AS (
        SELECT term, CAST(sum(n) AS BIGINT) AS n, count(*) AS df,
               row_number() OVER (ORDER BY sum(n) DESC, term) - 1 AS slot
        FROM entries GROUP BY 1)"""


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``row``, ``doc_id`` and ``counts``, saved. Each text is counted once; the vocabulary and the vectors are made from the
    saved counts."""
    counted = filtered_words_of(spark, sf_dir).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", counted_terms("words").alias("terms")
    )
    with stages(spark) as run:
        terms = materialise(counted, "counted")
        return run.keep(term_vectors(terms, "terms", "counts", fit_vocabulary(terms, "terms"), "row", keep_words=False))


@query("fit_vocabulary", f"WITH {ENTRIES_SQL} SELECT term, n, df, slot FROM vocabulary")
def _fit_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_vocabulary(filtered_words_of(spark, sf_dir), "words").select(
        "term", "n", F.col("df").cast("bigint").alias("df"), "slot"
    )


@query(
    "term_vectors",
    f"""WITH {ENTRIES_SQL}
        SELECT doc_id, count(*) AS n_terms, CAST(sum(entries.n) AS DOUBLE) AS n_words,
               CAST(sum(slot * entries.n) AS DOUBLE) AS slot_words
        FROM entries JOIN vocabulary USING (term) GROUP BY 1""",
)
def _term_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = vector_entries(document_vectors(spark, sf_dir), "counts", ["doc_id"])
    return entries.groupBy("doc_id").agg(
        F.count("slot").alias("n_terms"),
        F.sum("entry").alias("n_words"),
        F.sum(F.col("slot") * F.col("entry")).alias("slot_words"),
    )


def document_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    with stages(spark) as run:
        saved = document_vectors(spark, sf_dir)
        terms = saved.select(F.coalesce(F.max(F.unwrap_udt("counts").getField("size")), F.lit(0))).first()[0]
        model = fit_topic_table(saved, "counts", terms, "row")
        mixed = topic_shares(saved, model, "counts", "row", "mixture")
        return run.keep(mixed.select("doc_id", vector_to_array("mixture").alias("share")), "mixtures")


@query(
    "topic_mixture",
    """SELECT doc_id, CAST(topic AS INT) AS topic, true AS is_share
       FROM documents, (SELECT unnest(range(5)) AS topic)""",
)
def _topic_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares depend on the optimiser's arithmetic, so the row says whether each is one."""
    shares = document_topics(spark, sf_dir).select("doc_id", F.posexplode("share").alias("topic", "share"))
    return shares.select("doc_id", "topic", F.col("share").between(0.0, 1.0).alias("is_share"))


@query(
    "topic_mixture_totals",
    f"""WITH {ENTRIES_SQL}
        SELECT doc_id, CAST(5 AS INT) AS topics,
               CAST(doc_id IN (SELECT doc_id FROM entries) AS DOUBLE) AS total
        FROM documents""",
)
def _topic_mixture_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares add up to 1, or to 0 for a text without a term of the vocabulary."""
    total = F.aggregate("share", F.lit(0.0), lambda a, b: a + b)
    return document_topics(spark, sf_dir).select(
        "doc_id", F.size("share").alias("topics"), F.round(total, 6).alias("total")
    )


# --- features and regression ---------------------------------------------------------------------

BRANDS_SQL = """brands AS (SELECT p_partkey, nullif(p_brand, 'Brand#2') AS brand FROM part),
    ranks AS (SELECT brand, row_number() OVER (ORDER BY count(*) DESC, brand) - 1 AS rank
              FROM brands WHERE brand IS NOT NULL GROUP BY 1)"""


def part_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#2")).alias("brand")
    )


@query(
    "index_category",
    f"""WITH {BRANDS_SQL}
        SELECT p_partkey, CAST(coalesce(rank, (SELECT count(*) FROM ranks)) AS DOUBLE) AS brand_index
        FROM brands LEFT JOIN ranks USING (brand)""",
)
def _index_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_category(part_brands(spark, sf_dir), "brand", "brand_index").select(
        "p_partkey", "brand_index"
    )


@query(
    "one_hot",
    f"""WITH {BRANDS_SQL}
        SELECT p_partkey, CAST(rank AS INT) AS slot, 1.0::DOUBLE AS entry
        FROM brands JOIN ranks USING (brand)""",
)
def _one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = one_hot(part_brands(spark, sf_dir), {"brand": "brand_vector"})
    return vector_entries(encoded, "brand_vector", ["p_partkey"])


@query(
    "assemble_features",
    f"""WITH {LINE_SUPPLEMENT_SQL}
        SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, l_quantity AS quantity
        FROM part JOIN supplement ON p_partkey = l_partkey""",
)
def _assemble_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = assemble_features(part_features(spark, sf_dir), ["p_size", "l_quantity"])
    slots = vector_to_array("features")
    return features.select("p_partkey", slots[0].alias("size"), slots[1].alias("quantity"))


# Forests depend on the sampler's and the sums' order, so the queries on them give what holds for each
# fit: which rows take part, the table's form, and bounds that a right fit must keep.
HELD_OUT_SQL = "(('0x' || substr(md5('42|' || p_partkey), 1, 8))::BIGINT % 1000000 >= 800000)"
PART_INPUTS = {
    "label": "p_retailprice",
    "numeric": ["p_size", "l_quantity", "l_extendedprice"],
    "categories": {"p_brand": "brand_vector", "p_type": "type_vector"},
}


@query(
    "fit_regressor",
    f"""WITH {LINE_SUPPLEMENT_SQL}
        SELECT CAST(50 AS INT) AS n_trees,
               (SELECT CAST(3 + count(DISTINCT p_brand) + count(DISTINCT p_type) AS INT) FROM part) AS n_slots,
               count(*) AS fitted_rows, true AS better_than_mean
        FROM part JOIN supplement ON p_partkey = l_partkey""",
)
def _fit_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(part_features(spark, sf_dir))
    model = fit_regressor(rows, **PART_INPUTS)
    forest, fitted = model.stages[-1], materialise(predict(model, rows).select("p_retailprice", "prediction"))
    score = r2_score(fitted, "p_retailprice").select((F.col("r2") > 0).alias("better_than_mean"))
    return fitted.agg(F.count(F.lit(1)).alias("fitted_rows")).select(
        F.lit(forest.getNumTrees).alias("n_trees"),
        F.lit(forest.numFeatures).alias("n_slots"),
        "fitted_rows",
        score.scalar().alias("better_than_mean"),
    )


def importance_form(importances: DataFrame, model: PipelineModel) -> DataFrame:
    """One row per input with its place among the model's inputs, and what must hold of its importance and of their sum."""
    total = importances.agg(F.round(F.sum("Importance"), 6)).scalar()
    inputs = F.array(*[F.lit(name) for name in model.stages[-2].getInputCols()])
    return importances.select(
        "Feature",
        (F.array_position(inputs, F.col("Feature")) - 1).alias("place"),
        F.col("Importance").between(0.0, 1.0).alias("is_share"),
        total.alias("total"),
    )


def rows_used(model: PipelineModel, rows: DataFrame, label: str) -> Column:
    """How many rows the forest was given: those that the model's own stages before it do not drop."""
    before = PipelineModel(model.stages[:-1]).transform(rows.dropna(subset=[label]))
    return before.agg(F.count(F.lit(1))).scalar()


@query(
    "feature_importance",
    f"""WITH {LINE_SUPPLEMENT_SQL}, inputs AS (
            SELECT ['p_size', 'l_quantity', 'l_extendedprice', 'brand_vector', 'type_vector'] AS names)
        SELECT unnest(names) AS "Feature", unnest(range(len(names))) AS place, true AS is_share, 1.0::DOUBLE AS total,
               (SELECT count(*) FROM part JOIN supplement ON p_partkey = l_partkey) AS fitted_rows
        FROM inputs""",
)
def _feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(part_features(spark, sf_dir))
    model = fit_regressor(rows, **PART_INPUTS)
    form = importance_form(feature_importance(model, rows), model)
    return form.withColumn("fitted_rows", rows_used(model, rows, "p_retailprice"))


@query(
    "encode_by_label",
    f"""WITH rows AS (
            SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y,
                   ('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 8))::BIGINT % 10 AS fold FROM lineitem),
        m AS (SELECT avg(y) AS prior FROM rows),
        a AS (SELECT l_partkey, sum(y) AS s, count(*) AS c FROM rows GROUP BY 1),
        f AS (SELECT l_partkey, fold, sum(y) AS s, count(*) AS c FROM rows GROUP BY 1, 2)
        SELECT l_orderkey, l_linenumber, round((a.s - f.s + 10 * prior) / (a.c - f.c + 10), 4) AS from_others,
               round((a.s + 10 * prior) / (a.c + 10), 4) AS from_all
        FROM rows JOIN a USING (l_partkey) JOIN f USING (l_partkey, fold), m""",
)
def _encode_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category with a value per part: one number from the rows of other folds, one from all rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    keys = ["l_orderkey", "l_linenumber"]
    known, means = encode_by_label(lines, {"l_partkey": "from_others"}, "l_extendedprice", fold_by=keys)
    means.columns = {"l_partkey": "from_all"}
    return rounded(means.transform(known), 4, "from_others", "from_all").select(*keys, "from_others", "from_all")


@query(
    "fit_regressor_label_means",
    """SELECT count(*) AS fitted_rows, CAST(2 AS INT) AS n_slots, true AS better_than_mean
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def _fit_regressor_label_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many categories as parts in one column, and every line takes part."""
    prices = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    lines = materialise(enrich_left(lines, prices, "l_partkey", unique=True))
    inputs = {"label": "p_retailprice", "numeric": ["l_quantity"], "categories": {"l_partkey": "part_mean"}}
    model = fit_regressor(lines, **inputs, trees=10, encode="label_means", fold_by=["l_orderkey", "l_linenumber"])
    fitted = materialise(predict(model, lines).select("p_retailprice", "prediction"))
    score = r2_score(fitted, "p_retailprice").select((F.col("r2") > 0).alias("better_than_mean"))
    return fitted.agg(F.count(F.lit(1)).alias("fitted_rows")).select(
        "fitted_rows", F.lit(model.stages[-1].numFeatures).alias("n_slots"), score.scalar().alias("better_than_mean")
    )


@query("split_train_test", f"SELECT p_partkey, {HELD_OUT_SQL} AS held_out FROM part")
def _split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = split_train_test(table(spark, sf_dir, "part"), by=["p_partkey"])
    return train.select("p_partkey", F.lit(False).alias("held_out")).unionAll(
        test.select("p_partkey", F.lit(True).alias("held_out"))
    )


@query(
    "predict",
    f"""WITH {LINE_SUPPLEMENT_SQL}
        SELECT p_partkey, p_retailprice, true AS in_range
        FROM part JOIN supplement ON p_partkey = l_partkey WHERE {HELD_OUT_SQL}""",
)
def _predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest's prediction is a mean of labels it has seen, so it lies between them."""
    rows = materialise(part_features(spark, sf_dir))
    train, test = split_train_test(rows, by=["p_partkey"])
    seen = train.agg(F.min("p_retailprice").alias("low"), F.max("p_retailprice").alias("high"))
    low, high = seen.select(F.col("low") - 1e-6).scalar(), seen.select(F.col("high") + 1e-6).scalar()
    return predict(fit_regressor(train, **PART_INPUTS), test).select(
        "p_partkey", "p_retailprice", F.col("prediction").between(low, high).alias("in_range")
    )


@query(
    "r2_score",
    """SELECT round(1 - sum(power(o_totalprice - p, 2)) / sum(power(o_totalprice - m, 2)), 6) AS r2
       FROM (SELECT o_totalprice, o_totalprice * 0.9 + 1000 AS p,
                    (SELECT avg(o_totalprice) FROM orders) AS m FROM orders)""",
)
def _r2_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_totalprice", "o_totalprice * 0.9D + 1000 AS prediction"
    )
    return rounded(r2_score(orders, "o_totalprice"), 6, "r2")


DOCUMENT_ROWS_SQL = """WITH d AS (
    SELECT *, CAST(len(string_split(text, ' ')) AS INT) AS n_words FROM documents),
    kept AS (SELECT * FROM d WHERE source <> 'src3' AND lang <> 'de')"""


@query(
    "revenue_rows",
    DOCUMENT_ROWS_SQL
    + """ SELECT k.doc_id, source, lang, n_words AS "Runtime", round(n_chars / n_words, 4) AS "Rating",
               CAST(n_chars AS DOUBLE) AS "Gross", CAST(floor(n_chars / 10) * 10 AS INT) AS "Decade",
               CASE WHEN quality = 1 THEN 'good' WHEN quality IS NOT NULL THEN 'poor' END AS grade,
               quality, toxic, md5(text) AS digest
          FROM kept k LEFT JOIN labels l ON k.doc_id = l.doc_id""",
)
def _revenue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare_revenue_rows(
        document_catalogue(spark, sf_dir), label_supplement(spark, sf_dir), DOCUMENTS, DOCUMENT_LABELS
    )
    return rounded(rows, 4, "Rating").select(
        "doc_id",
        "source",
        "lang",
        "Runtime",
        "Rating",
        "Gross",
        "Decade",
        "grade",
        "quality",
        "toxic",
        F.md5("text").alias("digest"),
    )


@query(
    "revenue_report",
    DOCUMENT_ROWS_SQL
    + """ SELECT count(*) AS rows_read, count(*) FILTER (source <> 'src3') AS rows_after_first_drop,
               (SELECT count(*) FROM kept) AS rows_after_second_drop FROM d""",
)
def _revenue_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_report(document_catalogue(spark, sf_dir), DOCUMENTS)


@query(
    "revenue_model",
    DOCUMENT_ROWS_SQL
    + """, matched AS (
            SELECT ('0x' || substr(md5('42|' || k.doc_id), 1, 8))::BIGINT % 1000000 >= 800000 AS held_out
            FROM kept k JOIN labels l ON k.doc_id = l.doc_id),
        inputs AS (SELECT ['Rating', 'Runtime', 'quality', 'toxic', 'lang_Encoded', 'source_Encoded', 'grade_Encoded',
                           'topicDistribution'] AS names)
        SELECT unnest(names) AS "Feature", unnest(range(len(names))) AS place, true AS is_share, 1.0::DOUBLE AS total,
               (SELECT count(*) FROM kept) AS joined_rows,
               (SELECT count(*) FROM matched WHERE NOT held_out) AS fitted_rows,
               (SELECT count(*) FROM matched WHERE held_out) AS held_out_rows
        FROM inputs""",
)
def _revenue_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the model's own frames beside the importances' form."""
    model = revenue_model(
        document_catalogue(spark, sf_dir), label_supplement(spark, sf_dir), DOCUMENTS, DOCUMENT_LABELS, split_by=["doc_id"]
    )
    rows = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return importance_form(model.importances, model.regressor).select(
        "*",
        rows(model.joined).alias("joined_rows"),
        rows_used(model.regressor, model.train_rows, "Gross").alias("fitted_rows"),
        rows(model.predictions).alias("held_out_rows"),
    )


# --- streaming -----------------------------------------------------------------------------------


def run_stream(alerts: DataFrame) -> DataFrame:
    """Process what is available and read the result that was published last."""
    path = scratch_dir(alerts.sparkSession, "alerts")
    low_rated_stream(alerts, publish_each_batch(path), every=None).awaitTermination()
    return read_published(alerts.sparkSession, path)


@query("low_rated_stream_absolute", ORACLES["low_rated_absolute"])
def _low_rated_stream_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = scratch_dir(spark, "topic")
    publish_json(wire_form(event_reviews(spark, sf_dir)), topic)
    messages = stream_source(spark, "text", topic, "value string")
    alerts = run_stream(absolute_alerts(messages, 10.0, EVENT_MESSAGE, EVENTS))
    return rounded(alerts, 9, "Daily_Average_Rating")


@query("low_rated_stream_relative", ORACLES["low_rated_relative"])
def _low_rated_stream_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = scratch_dir(spark, "topic")
    publish_json(wire_form(with_overall(event_reviews(spark, sf_dir))), topic)
    messages = stream_source(spark, "text", topic, "value string")
    alerts = run_stream(relative_alerts(messages, 30.0, EVENT_MESSAGE_WITH_OVERALL, EVENTS, digits=GAP_DIGITS))
    return rounded(alerts, 9, "Daily_Average_Rating", "overall", "Rating_Difference")


@query(
    "json_files_to_messages",
    """SELECT event_id, user_id, round(value, 9) AS value, CAST(ts AS DATE) AS day FROM events""",
)
def _json_files_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects in JSON files, one message for each, typed rows again."""
    files, topic = scratch_dir(spark, "objects"), scratch_dir(spark, "topic")
    wire_form(event_reviews(spark, sf_dir)).write.json(files)
    publish_json(read_json_objects(spark, files, EVENT_MESSAGE), topic)
    typed = parse_json_messages(scan_table(spark, topic, "text"), EVENT_MESSAGE, "day")
    return rounded(typed, 9, "value").select("event_id", "user_id", "value", "day")


@query("low_rated_overwrite", ORACLES["low_rated_absolute"])
def _low_rated_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table, overwritten by each of at least four micro-batches; low values come first, so means rise
    and items leave the table again."""
    topic, target = scratch_dir(spark, "topic"), scratch_dir(spark, "table")
    ordered = event_reviews(spark, sf_dir).repartitionByRange(8, "value")
    publish_json(wire_form(ordered), topic)
    messages = stream_source(spark, "text", topic, "value string", maxFilesPerTrigger=2)
    alerts = absolute_alerts(messages, 10.0, EVENT_MESSAGE, EVENTS)
    low_rated_stream(alerts, overwrite_each_batch(target, "parquet"), every=None).awaitTermination()
    return rounded(scan_table(spark, target, "parquet"), 9, "Daily_Average_Rating")


@query("low_rated_stream_trigger", ORACLES["low_rated_absolute"])
def _low_rated_stream_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query with a trigger of two seconds that runs until it is stopped, some files a batch."""
    topic, path = scratch_dir(spark, "topic"), scratch_dir(spark, "alerts")
    publish_json(wire_form(event_reviews(spark, sf_dir).repartition(4)), topic)
    messages = stream_source(spark, "text", topic, "value string", maxFilesPerTrigger=2)
    alerts = absolute_alerts(messages, 10.0, EVENT_MESSAGE, EVENTS)
    running = low_rated_stream(alerts, publish_each_batch(path), every="2 seconds")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return rounded(read_published(spark, path), 9, "Daily_Average_Rating")


@query("low_rated_merged", ORACLES["low_rated_absolute"])
def _low_rated_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: each of at least four batches writes the means that changed; low values come first, so means
    rise and items leave the table again. Whole versions are written in between."""
    topic, path = scratch_dir(spark, "topic"), scratch_dir(spark, "merged")
    publish_json(wire_form(event_reviews(spark, sf_dir).repartitionByRange(8, "value")), topic)
    messages = stream_source(spark, "text", topic, "value string", maxFilesPerTrigger=2)
    daily = daily_ratings(messages, EVENT_MESSAGE, EVENTS)
    keys = [EVENTS.entity, EVENTS.day]
    writer = merge_each_batch(path, keys, F.col("Daily_Average_Rating") < 10.0, compact_every=3)
    low_rated_stream(daily, writer, mode="update", every=None).awaitTermination()
    return rounded(read_merged(spark, path, keys), 9, "Daily_Average_Rating")


@query("low_rated_stream_repeats", ORACLES["low_rated_relative"])
def _low_rated_stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is published twice, the second time later, and counts once."""
    topic = scratch_dir(spark, "topic")
    reviews = wire_form(with_overall(event_reviews(spark, sf_dir)))
    for _ in range(2):
        publish_json(reviews, topic)
    messages = stream_source(spark, "text", topic, "value string", maxFilesPerTrigger=1)
    alerts = relative_alerts(
        messages, 30.0, EVENT_MESSAGE_WITH_OVERALL, EVENTS, digits=GAP_DIGITS, distinct_by="event_id", late="4000 days"
    )
    return rounded(run_stream(alerts), 9, "Daily_Average_Rating", "overall", "Rating_Difference")
