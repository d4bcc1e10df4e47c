"""Hot products per area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions.text import concat_distinct, id_with_name, parsed_json, variant_field
from clickloom.sources.tables import default_cities

# Areas of each level, in both spellings; any other area is D Level.
AREA_LEVELS = {
    "A Level": ["华北", "华东", "China North", "China East"],
    "B Level": ["华南", "华中", "China South", "China Middle"],
    "C Level": ["西北", "西南", "West North", "West South"],
}
OTHER_LEVEL = "D Level"


def area_level(area: Column) -> Column:
    level = F.lit(OTHER_LEVEL)
    for name, areas in AREA_LEVELS.items():
        level = F.when(area.isin(*areas), name).otherwise(level)
    return level


def product_status(extend_info: Column) -> Column:
    own = variant_field(parsed_json(extend_info), "product_status") == "0"
    return F.when(own, "Self").otherwise("Third Party")


def area_product_counts(clicks: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """Clicks per area and product, with the cities they came from.

    The log is counted by city and product first: that aggregate combines before the
    shuffle, and the city join and the text set then see one row per city and product. The
    literal ten cities are broadcast; for a given city table Catalyst decides by its size.
    Placing the counts by product serves both the area aggregate and a later product join.
    """
    by_city = (
        clicks.groupBy("city_id", "product_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
        .repartition("product_id")
    )
    if cities is None:
        cities = F.broadcast(default_cities(clicks.sparkSession))
    return (
        by_city.join(cities, "city_id")
        .groupBy("area", "product_id")
        .agg(
            F.sum("clicks").alias("click_count"),
            concat_distinct(id_with_name(F.col("city_id"), F.col("city_name"))).alias("city_infos"),
        )
    )


def with_product(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Adds name and status; counts of unknown products are dropped."""
    described = products.select(
        "product_id", "product_name", product_status(F.col("extend_info")).alias("product_status")
    )
    return counts.join(described, "product_id")


def area_top_products(
    clicks: DataFrame, products: DataFrame, cities: DataFrame | None = None, limit: int = 3
) -> DataFrame:
    """The most clicked products of each area."""
    rank = Window.partitionBy("area").orderBy(F.desc("click_count"), "product_id")
    return (
        with_product(area_product_counts(clicks, cities), products)
        .withColumn("place", F.row_number().over(rank))
        .filter(F.col("place") <= limit)
        .select(
            "area",
            area_level(F.col("area")).alias("area_level"),
            "product_id",
            "city_infos",
            "click_count",
            "product_name",
            "product_status",
        )
    )
