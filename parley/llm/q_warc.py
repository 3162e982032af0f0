"""op8: all pages through WARC archives and back."""

from parley.llm.registry import query
from parley.llm.warc import MIN_REVISIT, round_trip
from parley.registry.base import table

SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id <> first THEN first END AS refers_to FROM f"""


@query("op8_warc", SQL)
def warc(spark, sf_dir):
    """Every page as it comes back from the archives; a record that fails its checks stops the query."""
    from pyspark.sql import functions as F

    x = round_trip(table(spark, sf_dir, "pages"))
    sure = F.when(F.col("error").isNull(), F.col("page_id")).otherwise(F.raise_error(F.col("error")).cast("long"))
    return x.select(sure.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
