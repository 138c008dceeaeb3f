"""Place collection: regions x keywords, searched, parsed, deduplicated against earlier runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators.dedup import dedupe_places, unseen
from ..schemas import PLACES


#: The longest keyword list that is broadcast, and the keywords of a group beyond it.
BROADCAST, GROUP = 100_000, 10_000


def query_plan(regions: DataFrame, keywords: DataFrame, broadcast: int = BROADCAST, group: int = GROUP) -> DataFrame:
    """(query_index, query): every region with every keyword, region-major, from 1.

    Both are lists of (position, value) that people write.  A keyword list of checked length is the
    broadcast side; a longer one is met in groups, by an equi-join on the group's number."""
    k = keywords.count()
    left = regions.select(F.col("position").alias("r"), F.col("value").alias("region"))
    right = keywords.select(F.col("position").alias("k"), F.col("value").alias("keyword"))
    if k <= broadcast:
        pairs = left.crossJoin(F.broadcast(right))
    else:
        n = -(-k // group)
        pairs = left.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(right.withColumn("g", F.pmod("k", F.lit(n)).cast("int")), "g")
    return pairs.select(((F.col("r") - 1) * k + F.col("k")).cast("long").alias("query_index"), F.concat_ws(" ", "region", "keyword").alias("query"))


def place_rows(queries: DataFrame, items: DataFrame) -> DataFrame:
    """Place rows of the queries' results, with ``position`` (query, then result).

    items: query, pos, title, link, category, description, telephone, address, roadAddress, mapx, mapy."""
    hits = queries.join(items.filter("pos is not null"), "query")
    main, sub, detail = D.address_parts("address")
    link = T.col("link")
    return hits.select(
        (F.col("query_index") * 1000 + F.col("pos")).alias("position"), T.strip_tags("title").alias("title"), link.alias("link"), F.lit("").alias("start_date"), F.lit("").alias("end_date"),
        T.col("address").alias("full_address"), T.col("roadAddress").alias("road_address"), main.alias("region_main"), sub.alias("region_sub"), detail.alias("region_detail"), link.alias("official_url"),
        T.strip_tags("description").alias("summary"), T.col("telephone").alias("tel"), T.col("category").alias("category"), F.lit("unknown").alias("price"), T.col("mapx").alias("mapx"), T.col("mapy").alias("mapy"), F.col("query").alias("source_query"),
    )


def collect_places(queries: DataFrame, items: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """New places only: the first of each (title, full_address, official_url) that no earlier run has."""
    rows = dedupe_places(place_rows(queries, items))
    if before is not None:
        rows = unseen(rows, before, ["title", "full_address", "official_url"])
    return rows.select("position", *PLACES)
