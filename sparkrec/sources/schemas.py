"""Declared schemas of the reference's file formats (never inferred)."""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, MapType, StringType, StructField,
                               StructType, VariantType)

RATINGS_CSV = StructType([StructField("user_id", StringType()), StructField("business_id", StringType()),
                          StructField("stars", DoubleType())])
CANDIDATES_CSV = StructType([StructField("user_id", StringType()), StructField("business_id", StringType()),
                             StructField("stars", StringType())])   # label column ignored when scoring
PREDICTIONS_CSV = StructType([StructField("user_id", StringType()), StructField("business_id", StringType()),
                              StructField("prediction", DoubleType())])
COMPARISON_CSV = StructType([StructField("user_id", StringType()), StructField("business_id", StringType()),
                             StructField("c2", DoubleType()), StructField("p3", DoubleType()),
                             StructField("p4", DoubleType()), StructField("p5", DoubleType())])

_COUNTS = ["review_count", "useful", "funny", "cool", "fans"] + [
    f"compliment_{c}" for c in ["hot", "more", "profile", "cute", "list", "note", "plain", "cool", "funny",
                                "writer", "photos"]]
USER_JSON = StructType([StructField("user_id", StringType()), StructField("name", StringType()),
                        StructField("yelping_since", StringType()), StructField("friends", StringType()),
                        StructField("elite", StringType()), StructField("average_stars", DoubleType())]
                       + [StructField(c, LongType()) for c in _COUNTS])
ITEM_JSON = StructType([StructField("business_id", StringType()), StructField("name", StringType()),
                        StructField("neighborhood", StringType()), StructField("address", StringType()),
                        StructField("city", StringType()), StructField("state", StringType()),
                        StructField("postal_code", StringType()), StructField("latitude", DoubleType()),
                        StructField("longitude", DoubleType()), StructField("stars", DoubleType()),
                        StructField("review_count", LongType()), StructField("is_open", IntegerType()),
                        StructField("attributes", MapType(StringType(), VariantType())),
                        StructField("categories", StringType()),
                        StructField("hours", MapType(StringType(), StringType()))])
