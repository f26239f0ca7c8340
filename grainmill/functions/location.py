"""Province, city and district out of the location text of an address range."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .scalars import blank, col

# How a location text begins or is built, and the texts for unknown places and the local network.
MUNICIPALITY = "^(?:北京|天津|上海|重庆)市"
TWO_CHARACTER_REGION = "^(?:西藏|新疆|香港|澳门)"
THREE_CHARACTER_REGION = "^内蒙古"
IN_PROVINCE = "^.+省"
WITH_PREFECTURE = "^.+省.{2,}州"
WITH_CITY = "^.+省.{2,}市"
WITH_PREFECTURE_AND_CITY = "^.+省.{2,}州.{2,}市"
UNKNOWN_PROVINCE = "未知"
UNKNOWN_COUNTRY = "未知国家"
UNKNOWN_AREA = "未知地区"
LOCAL_NETWORK_AREA = "CZ88.NET"


def location_parts(country: Column | str) -> Column:
    """A struct of province, city and district of one location text; city and district are null where it names none."""
    c = col(country)
    begins = lambda pattern: F.trim(c).rlike(pattern)
    at = {mark: F.instr(c, mark) for mark in "省州市"}
    between = lambda a, b: F.substr(c, at[a] + 1, F.greatest(at[b] - at[a], F.lit(0)))
    beyond = lambda mark: F.substr(c, at[mark] + 1)
    head = lambda n: F.substring(c, 1, n)
    tail = lambda n: F.substr(c, F.lit(n + 1))
    none = F.lit(None).cast("string")
    region_city = F.when(begins(TWO_CHARACTER_REGION), tail(2)).when(begins(THREE_CHARACTER_REGION), tail(3))

    def place(province: Column, city: Column, district: Column = none) -> Column:
        return F.struct(
            province.alias("province"), F.nullif(city, F.lit("")).alias("city"), F.nullif(district, F.lit("")).alias("district")
        )

    province = F.substring_index(c, "省", 1)
    return (
        F.when(begins(MUNICIPALITY), place(head(2), tail(3)))
        .when(begins(WITH_PREFECTURE_AND_CITY), place(province, between("州", "市"), beyond("市")))
        .when(begins(WITH_PREFECTURE), place(province, between("省", "州"), beyond("州")))
        .when(begins(WITH_CITY), place(province, between("省", "市"), beyond("市")))
        .when(begins(IN_PROVINCE), place(province, region_city))
        .when(begins(TWO_CHARACTER_REGION), place(head(2), tail(2)))
        .when(begins(THREE_CHARACTER_REGION), place(head(3), tail(3)))
        .otherwise(place(F.when(blank(c), UNKNOWN_PROVINCE).otherwise(c), none))
    )


def province_of(country: Column | str) -> Column:
    return location_parts(country)["province"]


def city_of(country: Column | str) -> Column:
    """City text, null when the location names none."""
    return location_parts(country)["city"]


def district_of(country: Column | str) -> Column:
    """District text, null when the location names none."""
    return location_parts(country)["district"]


def area_of(area: Column | str) -> Column:
    """Network area; null for the local network and for blanks (reported as "other")."""
    c = col(area)
    return F.when(~blank(c) & (F.trim(c) != LOCAL_NETWORK_AREA), c)
