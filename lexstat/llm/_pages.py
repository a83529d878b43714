"""The valid version of a page."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_pages(articles: DataFrame, *cols: str) -> DataFrame:
    """page_id and cols of each page's row with the latest fetched_at; ties: latest loaded_at, then the larger text.

    Rows with a null page_id are no page; a null fetched_at is older than any.
    """
    rest = [c for c in cols if c not in ("text", "source_name")]
    order = ["fetched_at", "loaded_at", "text", "source_name", *rest]
    d = articles.where(F.col("page_id").isNotNull()).select("page_id", F.struct(*order).alias("v"))
    return d.groupBy("page_id").agg(F.max("v").alias("v")).select("page_id", *[F.col(f"v.{c}").alias(c) for c in cols])
