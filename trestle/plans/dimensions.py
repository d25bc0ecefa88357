"""Region / market dimensions (R-30, R-44, R-65)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trestle.functions import word
from trestle.operators import joins as J
from trestle.plans.registry import query
from trestle.sources.tables import Tables


def _divisions(t: Tables) -> DataFrame:
    return t.fx.office_division.select("office_division_id", "office_division_description").distinct()


def _areas(t: Tables) -> DataFrame:
    """Practice areas, 'Water Resources' shortened to 'Water'."""
    name = F.col("practice_area_name")
    return t.fx.practice_area.select(
        "practice_area_id", F.when(name == "Water Resources", "Water").otherwise(name).alias("practice_area_name")).distinct()


@query("cross_region_market")
def dim_crm_region_market(t: Tables) -> DataFrame:
    """R-30/J-6: every CRM division x practice area.

    The reference crosses the two full tables and then takes DISTINCT; here each side is made distinct first
    (same result), so the product is |divisions| x |areas| of the dimension domains.
    """
    return J.all_pairs(_divisions(t), _areas(t))


# Market abbreviation prefix -> (market, market group).
MARKETS = (("ED%", "Education", "Building"), ("HC%", "Healthcare", "Building"), ("IND%", "Industrial", "Building"),
           ("Water", "Water", "Water"))


@query("dim_region_market")
def dim_region_market(t: Tables) -> DataFrame:
    """R-44/R-65: parse 'Region - <region> <market>' department names; attach CRM ids by name.

    Not distinct: the same department in two companies yields two rows, which every consumer joins to (kept).
    """
    d = t.fx.dept.filter(F.col("description").like("Region%"))
    sub = F.replace(F.col("description"), F.lit("Region - "), F.lit(""))
    great_lakes = sub.like("Great Lakes%")
    d = d.withColumns({
        "region": F.when(great_lakes, F.lit("Great Lakes")).otherwise(word(sub, 0)),
        "_abbr": F.when(great_lakes, word(sub, 2)).otherwise(word(sub, 1)),
    })
    abbr = F.col("_abbr")
    market = None
    group = None
    for pat, name, grp in MARKETS:
        m = abbr.like(pat)
        market = F.when(m, name) if market is None else market.when(m, name)
        group = F.when(m, grp) if group is None else group.when(m, grp)
    d = d.select("department", F.substring("department", 1, 2).alias("region_number"),
                 F.substring("department", 3, 4).alias("market_number"), "description", "region",
                 F.when(abbr.like("ED%"), "EDU").otherwise(abbr).alias("market_abbr"),
                 market.alias("market"), group.alias("market_abstraction"))
    # Only the two sides of the CRM product are needed, not the pairs.  (With one CRM table empty the product is
    # empty and no id would be found; here the ids of the other table still are.)
    regions, markets = _divisions(t), _areas(t)
    j = (d.join(regions, d.region == regions.office_division_description, "left")
         .join(markets, F.trim(d.market) == F.trim(markets.practice_area_name), "left"))
    # The output column names of the region/market dimension (CRM ids keep their source name).
    return j.select("department", "region_number", "market_number",
                    F.col("office_division_id").alias("unanet_region_id"),
                    F.col("practice_area_id").alias("unanet_market_id"),
                    "description", "region", "market_abbr", "market", "market_abstraction")
