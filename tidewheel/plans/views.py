"""Ratings, events, segments and factors derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import label_column
from tidewheel.operators.cleaning import clean_ratings
from tidewheel.operators.events import clean_events, parse_events, validate_events
from tidewheel.session import use_utc

# Events lie minutes apart, so windows are wider here than the defaults; window and slide
# keep their ratio of three to one.
ITEM_WINDOW, ITEM_SLIDE = "24 hours", "8 hours"
USER_WINDOW, USER_SLIDE = "9 days", "3 days"
VISIT_GAP = "36 hours"
# 1996-01-01, which parts the ratings in two.
CUT_MILLIS = 820_454_400_000


class Views:
    """The derived views over one folder of tables; each is a lazy frame."""

    def __init__(self, spark: SparkSession, folder: str):
        use_utc(spark)
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # Reviews

    def ratings_raw(self) -> DataFrame:
        lines = self.table("lineitem")
        orders = self.table("orders")
        rating = F.when(F.col("l_quantity") == 50, F.lit(None)).otherwise(F.col("l_quantity") % 7)
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
            F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("user_id"),
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("parent_asin"),
            rating.alias("rating"),
            F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
            "l_orderkey",
            "l_linenumber",
        )

    def cleaned(self) -> DataFrame:
        return clean_ratings(self.ratings_raw())

    def ratings(self) -> DataFrame:
        """Cleaned ratings with the integer ids the names are made of."""
        return self.cleaned().select(
            "*", _number("user_id").alias("user_idx"), _number("item_id").alias("item_idx")
        )

    def items(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("item_id"),
            F.col("p_partkey").cast("int").alias("item_idx"),
        )

    def item_metadata(self) -> DataFrame:
        """One record per part, every tenth without a title, and a later second one for some."""
        part = self.table("part")
        asin = F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("parent_asin")
        title = F.when(F.col("p_partkey") % 10 == 0, F.lit(None)).otherwise(
            F.concat_ws(" ", "p_name", "p_type", "p_brand")
        )
        first = part.select(asin, title.alias("title"), F.lit(0).alias("record_order"))
        second = part.filter(F.col("p_size") > 25).select(
            asin, F.col("p_brand").alias("title"), F.lit(1).alias("record_order")
        )
        return first.unionByName(second)

    def predictions(self) -> DataFrame:
        """Cleaned ratings with a made prediction, to check the error formula."""
        return self.ratings().select("rating", (1 + F.col("item_idx") % 9 * F.lit(0.5)).alias("prediction"))

    # Segments and factors

    def segments(self) -> DataFrame:
        users = self.table("orders").select(F.col("o_custkey").cast("int").alias("user_idx")).distinct()
        return _with_segment(users)

    def partial_segments(self) -> DataFrame:
        """Segments of the customers in credit only."""
        users = self.table("customer").filter("c_acctbal >= 0")
        return _with_segment(users.select(F.col("c_custkey").cast("int").alias("user_idx")))

    def factors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").cast("int").alias("id"), F.col("embedding").alias("features")
        )

    def router_users(self) -> DataFrame:
        """Everybody who may ask: customers, users with events, and the shared cold id."""
        customers = self.table("customer").select(F.col("c_custkey").alias("user_id"))
        return customers.unionByName(self.validated().filter("user_id IS NOT NULL").select("user_id"))

    # Events

    def messages(self) -> DataFrame:
        """``(value, timestamp)``: signups are cold, errors are malformed in three ways."""
        k = F.get_json_object("props", "$.k").cast("bigint")
        tenths = (
            F.when(F.col("event_id") % 13 == 0, F.lit(5))
            .when(k % 10 == 7, 46 + F.col("event_id") % 4)
            .otherwise(10 + 5 * (F.col("event_id") % 9))
        )
        good = F.to_json(
            F.struct(
                F.when(F.col("event_type") == "signup", F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
                k.alias("item_id"),
                (tenths.cast("decimal(4,0)") / F.lit(10)).cast("decimal(4,1)").alias("rating"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            )
        )
        bad = (
            F.when(F.col("event_id") % 3 == 0, F.lit("{bad"))
            .when(F.col("event_id") % 3 == 1, F.lit("[1]"))
            .otherwise(
                F.lit('{"user_id":"CORRUPTED","item_id":null,"rating":"N/A","timestamp":"bad-ts"}')
            )
        )
        arrival = F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.col("event_id") % 7)
        return self.table("events").select(
            F.when(F.col("event_type") == "error", bad).otherwise(good).alias("value"),
            arrival.alias("timestamp"),
        )

    def validated(self) -> DataFrame:
        return validate_events(parse_events(self.messages()))

    def events(self) -> DataFrame:
        return clean_events(self.validated())


def _number(name: str) -> Column:
    return F.expr(f"substring({name}, 2)").cast("int")


def _with_segment(users: DataFrame) -> DataFrame:
    segment = (F.col("user_idx") % 5).cast("int")
    return users.select("user_idx", segment.alias("segment"), label_column(segment).alias("segment_label"))
