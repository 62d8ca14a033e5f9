"""Input frames for the registered queries, derived from the given tables.

events carries usage messages, metadata messages and query-log lines; part carries metadata and
watched products; orders and customer carry wide query-log lines.
"""

from pyspark.sql import functions as F

from logweir.session import work_folder
from logweir.sources.messages import BODY

FILE_EVERY, BREAK_EVERY, SHORT_EVERY = 20, 10, 7
CAPTURES = [(0, 15), (1_000_000_000_000, 13)]
CAPTURED_ACTIVITIES = [
    ("purchase", "Download"), ("click", "Login"), ("view", "Data Query"), ("error", "API Access"),
]
SHOP = "https://shop.example/item/"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixed_now():
    return F.lit("2024-02-01 12:34:56").cast("timestamp_ntz")


def _text(*parts):
    return F.concat(*[part if not isinstance(part, str) else F.lit(part) for part in parts])


def activity():
    kind = F.col("event_type")
    return (
        F.when(kind == "purchase", "Download")
        .when(kind == "click", "Login")
        .when(kind == "view", "Data Query")
        .when(kind == "error", "API Access")
        .otherwise("Upload")
    )


def usage_columns():
    return [
        F.date_format("ts", "dd/MMM/yyyy").alias("start_date"),
        F.date_format("ts", "HH:mm").alias("start_time"),
        _text("np", F.col("user_id")).alias("id"),
        _text("onto_", F.col("user_id") * FILE_EVERY).alias("ontology"),
        activity().alias("activity"),
    ]


def _body(columns, broken):
    text = F.to_json(F.struct(*columns))
    if broken:
        cut = F.substring(text, 1, 20)
        text = F.when(F.col("event_id") % BREAK_EVERY == 0, cut).otherwise(text)
    return text.cast("binary").alias(BODY)


def usage_messages(events, broken=False):
    """One JSON message per event; with `broken` every tenth body is cut short."""
    return events.select("event_id", _body(usage_columns(), broken))


def extended_messages(events):
    """Usage messages with more in them: of every three, one has nested and numeric fields of its
    own, one a numeric activity and a field twice, and one nothing more."""
    own = _text('{"id":"np', F.col("user_id"), '","activity":')
    nested = _text(own, '"Login","extra":{"n":', F.col("event_id"), ',"kinds":["', F.col("event_type"), '",null]}}')
    wrong = _text(own, F.col("user_id"), ',"seen":1,"seen":"', F.col("event_type"), '"}')
    plain = _text(own, '"Login"}')
    kind = F.col("event_id") % 3
    body = F.when(kind == 0, nested).when(kind == 1, wrong).otherwise(plain)
    return events.select("event_id", body.cast("binary").alias(BODY))


def usage(events):
    return events.select(*usage_columns())


def metadata(part):
    return part.select(
        _text("onto_", F.col("p_partkey")).alias("ontology"),
        _text("file_", F.col("p_partkey"), ".owl").alias("filename"),
        F.col("p_size").cast("string").alias("size_in_kb"),
    )


def metadata_messages(events):
    """Metadata messages, many per ontology, for known and new ontologies alike."""
    columns = [
        _text("onto_", F.col("user_id") * FILE_EVERY).alias("ontology"),
        _text("file_", F.col("event_id"), ".owl").alias("filename"),
        F.col("value").cast("string").alias("size_in_kb"),
    ]
    return events.select("event_id", _body(columns, False))


def event_log_line():
    """24 fields of one query-log line."""
    own = ["event_id", "user_id", "event_type", "value"]
    fields = [F.col(own[at % 4]).cast("string") for at in range(24)]
    return F.concat_ws("\t", *fields)


def order_log_lines(orders, customer):
    """(o_orderkey, time, path, log): wide lines, every seventh with three fields only."""
    own = [
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        "c_name",
        "c_acctbal",
        "c_mktsegment",
    ]
    fields = [F.col(own[at % 8]).cast("string") for at in range(24)]
    short = F.concat_ws("\t", *fields[:3])
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    log = F.when(F.col("o_orderkey") % SHORT_EVERY == 0, short)
    return rows.select(
        "o_orderkey",
        F.col("o_orderdate").alias("time"),
        log_path(F.col("o_orderkey"), F.col("o_orderdate")).alias("path"),
        log.otherwise(F.concat_ws("\t", *fields)).alias("log"),
    )


def log_path(number, time):
    return _text(
        "/logs/AVDP",
        number % 4 + 1,
        "/queries.log.",
        F.date_format(time, "MMddyyyy"),
    )


def stage_json_logs(spark, sf_dir, which=None, folder=None):
    """Write the events as JSON-lines query logs, one folder per server and day; returns the
    folder. Every fiftieth line is cut short and every fiftieth has no time. `which` events are
    delivered now, into the given folder."""
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    spot = F.col("event_id") % 50
    text = F.to_json(
        F.struct(F.when(spot != 1, time).alias("@timestamp"), event_log_line().alias("log"))
    )
    folder = folder or work_folder(spark, "query-logs")
    events = table(spark, sf_dir, "events")
    (
        (events if which is None else events.where(which))
        .select(
            F.when(spot == 0, F.substring(text, 1, 40)).otherwise(text).alias("value"),
            _text("AVDP", F.col("event_id") % 2 + 1).alias("server"),
            F.date_format("ts", "MMddyyyy").alias("day"),
        )
        .write.mode("append")
        .partitionBy("server", "day")
        .text(folder)
    )
    return folder


STAGED_LAYOUT = "server={directory}/day={day}"
STAGED_DAY = r"/day=(\d{8})/"


def product_pages(part):
    """Two captures of each product page; a third of the pages have the deal price, a third
    the list price, a third no price."""
    captures = F.array(
        *[
            F.struct(F.lit(ahead).alias("ahead"), F.lit(factor).alias("factor"))
            for ahead, factor in CAPTURES
        ]
    )
    rows = part.select("p_partkey", "p_retailprice", F.explode(captures).alias("c"))
    kind = F.col("p_partkey") % 3
    name = F.when(kind == 0, "priceblock_dealprice").when(kind == 1, "priceblock_ourprice")
    price = F.format_number(F.col("p_retailprice") * F.col("c.factor"), 2)
    element = _text('<span class="price" id="', F.coalesce(name, F.lit("none")), '">₹ ', price)
    return rows.select(
        (F.col("p_partkey") + F.col("c.ahead")).alias("page_id"),
        _text(SHOP, F.col("p_partkey")).alias("url"),
        _text("<html><body><h1>Item</h1>", element, "</span></body></html>").alias("html"),
    )


def priced_pages(pages):
    """The given pages with a price ahead of the end of their body; pages without one stay."""
    amount = F.format_number(F.col("page_id") % 5000 * 13 + F.lit(0.25), 2)
    element = _text('<span id="priceblock_ourprice">₹ ', amount, "</span></body>")
    return pages.select("page_id", "url", F.replace("html", F.lit("</body>"), element).alias("html"))


def nested_pages(pages):
    """The given pages with an element ahead of the end of their body that nests two of its kind; in
    every third one of those is left open."""
    number = F.col("page_id")
    inner = F.when(number % 3 == 0, "").otherwise("</div>")
    element = _text(
        '<div id="offer">a', number, "<div>b<b>c</b><div class='d'>d</div>e", inner, "f</div></body>"
    )
    return pages.select("page_id", "url", F.replace("html", F.lit("</body>"), element).alias("html"))


def page_watchlist(pages):
    """Three products of each page."""
    return pages.select("page_id", "url", F.explode(F.array(*map(F.lit, range(3)))).alias("k")).select(
        _text("item ", F.col("page_id"), "-", F.col("k")).alias("Model"),
        F.col("url").alias("URL"),
        (F.col("k") * 20_000 + 500).cast("int").alias("Target Price"),
    )


def watchlist(part):
    return part.select(
        _text(F.col("p_name"), " ", F.col("p_partkey")).alias("Model"),
        _text(SHOP, F.col("p_partkey")).alias("URL"),
        (F.lit(11_000) + F.col("p_size") * 40).cast("int").alias("Target Price"),
    )
