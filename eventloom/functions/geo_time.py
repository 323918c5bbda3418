"""UTC offsets by place and local-time arithmetic on microsecond timestamps.

Nothing here reads the session time zone: local time is integer arithmetic, so the
same rows give the same hours on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 60 * MICROS_PER_MINUTE
MICROS_PER_DAY = 24 * MICROS_PER_HOUR

# Minutes from UTC by country, without daylight saving. A place that is
# not listed has offset 0.
COUNTRY_OFFSETS: tuple[tuple[str, int], ...] = (
    ("Brazil", -180), ("Colombia", -300), ("Peru", -300), ("Ecuador", -300),
    ("Chile", -240), ("Argentina", -180), ("Uruguay", -180), ("Venezuela", -240),
    ("Bolivia", -240), ("Paraguay", -180), ("Guatemala", -360), ("El Salvador", -360),
    ("Costa Rica", -360), ("Honduras", -360), ("Panama", -300), ("Jamaica", -300),
    ("Dominican Republic", -240), ("Trinidad & Tobago", -240), ("Puerto Rico", -240),
    ("Bahamas", -300), ("United Kingdom", 0), ("Ireland", 0), ("Portugal", 0),
    ("Iceland", 0), ("Germany", 60), ("France", 60), ("Italy", 60), ("Netherlands", 60),
    ("Belgium", 60), ("Switzerland", 60), ("Austria", 60), ("Sweden", 60), ("Norway", 60),
    ("Denmark", 60), ("Poland", 60), ("Czechia", 60), ("Hungary", 60), ("Croatia", 60),
    ("Serbia", 60), ("Slovakia", 60), ("Slovenia", 60), ("Bosnia & Herzegovina", 60),
    ("North Macedonia", 60), ("Albania", 60), ("Kosovo", 60), ("Malta", 60),
    ("Luxembourg", 60), ("Finland", 120), ("Greece", 120), ("Romania", 120),
    ("Bulgaria", 120), ("Ukraine", 120), ("Lithuania", 120), ("Latvia", 120),
    ("Estonia", 120), ("Cyprus", 120), ("Belarus", 180), ("Georgia", 240),
    ("Turkey", 180), ("Israel", 120), ("Palestine", 120), ("Jordan", 180),
    ("Lebanon", 120), ("Iraq", 180), ("Bahrain", 180), ("Saudi Arabia", 180),
    ("Kuwait", 180), ("Qatar", 180), ("Oman", 240), ("United Arab Emirates", 240),
    ("Armenia", 240), ("Azerbaijan", 240), ("Egypt", 120), ("Nigeria", 60),
    ("Kenya", 180), ("Ethiopia", 180), ("South Africa", 120), ("Ghana", 0),
    ("Algeria", 60), ("Morocco", 60), ("Tunisia", 60), ("Pakistan", 300), ("India", 330),
    ("Sri Lanka", 330), ("Nepal", 345), ("Bangladesh", 360), ("Kazakhstan", 360),
    ("Myanmar (Burma)", 390), ("Thailand", 420), ("Vietnam", 420), ("Cambodia", 420),
    ("Laos", 420), ("Mongolia", 480), ("China", 480), ("Singapore", 480),
    ("Malaysia", 480), ("Philippines", 480), ("Taiwan", 480), ("Hong Kong", 480),
    ("Macao", 480), ("South Korea", 540), ("Japan", 540), ("New Zealand", 720),
    ("Papua New Guinea", 600), ("United States", -300), ("Canada", -300), ("Russia", 180),
    ("Australia", 600), ("Mexico", -360), ("Indonesia", 420), ("Spain", 60),
)

# Minutes from UTC by country and region; they go before the country's.
REGION_OFFSETS: tuple[tuple[str, str, int], ...] = (
    ("United States", "California", -480),
    ("United States", "Washington", -480),
    ("United States", "Oregon", -480),
    ("United States", "Nevada", -480),
    ("United States", "Alaska", -540),
    ("United States", "Hawaii", -600),
    ("United States", "Colorado", -420),
    ("United States", "Arizona", -420),
    ("United States", "Utah", -420),
    ("United States", "Idaho", -420),
    ("United States", "New Mexico", -420),
    ("United States", "Wyoming", -420),
    ("United States", "Montana", -420),
    ("United States", "Texas", -360),
    ("United States", "Illinois", -360),
    ("United States", "Tennessee", -360),
    ("United States", "Missouri", -360),
    ("United States", "Wisconsin", -360),
    ("United States", "Minnesota", -360),
    ("United States", "Iowa", -360),
    ("United States", "Kansas", -360),
    ("United States", "Louisiana", -360),
    ("United States", "Nebraska", -360),
    ("United States", "Oklahoma", -360),
    ("United States", "Mississippi", -360),
    ("United States", "Arkansas", -360),
    ("United States", "Alabama", -360),
    ("United States", "North Dakota", -360),
    ("United States", "South Dakota", -360),
    ("United States", "New York", -300),
    ("United States", "Virginia", -300),
    ("United States", "Florida", -300),
    ("United States", "Massachusetts", -300),
    ("United States", "Pennsylvania", -300),
    ("United States", "New Jersey", -300),
    ("United States", "Georgia", -300),
    ("United States", "North Carolina", -300),
    ("United States", "Ohio", -300),
    ("United States", "Michigan", -300),
    ("United States", "Maryland", -300),
    ("United States", "Indiana", -300),
    ("United States", "Connecticut", -300),
    ("United States", "South Carolina", -300),
    ("United States", "District of Columbia", -300),
    ("United States", "Maine", -300),
    ("United States", "West Virginia", -300),
    ("United States", "Delaware", -300),
    ("United States", "Rhode Island", -300),
    ("United States", "Vermont", -300),
    ("United States", "New Hampshire", -300),
    ("United States", "Kentucky", -300),
    ("Canada", "British Columbia", -480),
    ("Canada", "Alberta", -420),
    ("Canada", "Saskatchewan", -360),
    ("Canada", "Manitoba", -360),
    ("Canada", "Ontario", -300),
    ("Canada", "Quebec", -300),
    ("Canada", "Nova Scotia", -240),
    ("Canada", "New Brunswick", -240),
    ("Canada", "Prince Edward Island", -240),
    ("Canada", "Newfoundland and Labrador", -210),
    ("Russia", "Moscow", 180),
    ("Russia", "Moscow Oblast", 180),
    ("Russia", "Krasnodar Krai", 180),
    ("Russia", "Saint Petersburg", 180),
    ("Russia", "Sverdlovsk Oblast", 300),
    ("Australia", "New South Wales", 600),
    ("Australia", "Victoria", 600),
    ("Australia", "Queensland", 600),
    ("Australia", "Australian Capital Territory", 600),
    ("Australia", "South Australia", 570),
    ("Australia", "Western Australia", 480),
    ("Mexico", "Baja California", -480),
    ("Mexico", "Sonora", -420),
    ("Mexico", "Chihuahua", -420),
    ("Mexico", "Quintana Roo", -300),
    ("Mexico", "Mexico City", -360),
    ("Mexico", "Jalisco", -360),
    ("Mexico", "Tamaulipas", -360),
    ("Mexico", "Puebla", -360),
    ("Mexico", "Veracruz", -360),
    ("Mexico", "Queretaro", -360),
    ("Mexico", "Guanajuato", -360),
    ("Indonesia", "Jakarta", 420),
    ("Indonesia", "West Java", 420),
    ("Indonesia", "East Java", 420),
    ("Indonesia", "Banten", 420),
    ("Indonesia", "Central Java", 420),
    ("Indonesia", "Special Region of Yogyakarta", 420),
    ("Indonesia", "North Sumatra", 420),
    ("Indonesia", "Riau Islands", 420),
    ("Indonesia", "South Sulawesi", 480),
    ("Spain", "Canary Islands", 0),
)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def country_offsets(spark: SparkSession) -> DataFrame:
    """(offset_country, country_minutes): about a hundred fixed rows."""
    rows = ", ".join(
        f"({_literal(country)}, {minutes})" for country, minutes in COUNTRY_OFFSETS
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(offset_country, country_minutes)")


def region_offsets(spark: SparkSession) -> DataFrame:
    """(offset_country, offset_region, region_minutes): about a hundred fixed rows."""
    rows = ", ".join(
        f"({_literal(country)}, {_literal(region)}, {minutes})"
        for country, region, minutes in REGION_OFFSETS
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS t(offset_country, offset_region, region_minutes)"
    )


def with_offset_minutes(
    df: DataFrame, country: str = "country", region: str = "region"
) -> DataFrame:
    """Add ``offset_minutes``: the region's rule, else the country's, else 0.

    Both lookup tables are constants of this module, so broadcasting them is bounded
    whatever the size of ``df``.
    """
    spark = df.sparkSession
    regions = region_offsets(spark).withColumnRenamed("offset_country", "region_country")
    joined = df.join(
        F.broadcast(regions),
        (df[country] == regions["region_country"]) & (df[region] == regions["offset_region"]),
        "left",
    )
    countries = country_offsets(spark)
    joined = joined.join(
        F.broadcast(countries), df[country] == countries["offset_country"], "left"
    )
    return joined.withColumn(
        "offset_minutes",
        F.coalesce("region_minutes", "country_minutes", F.lit(0)),
    ).drop(
        "region_country", "offset_region", "region_minutes",
        "offset_country", "country_minutes",
    )


def offset_label(minutes: Column) -> Column:
    """``UTC+HH:MM`` or ``UTC-HH:MM``."""
    size = F.abs(minutes)

    def two_digits(value: Column) -> Column:
        return F.lpad(value.cast("int").cast("string"), 2, "0")

    return F.concat(
        F.when(minutes >= 0, F.lit("UTC+")).otherwise(F.lit("UTC-")),
        two_digits((size - size % 60) / 60),
        F.lit(":"),
        two_digits(size % 60),
    )


def local_hour(micros: Column, minutes: Column) -> Column:
    """Hour 0-23 of a UTC microsecond timestamp shifted by an offset in minutes."""
    of_day = F.pmod(micros + minutes.cast("long") * MICROS_PER_MINUTE, F.lit(MICROS_PER_DAY))
    return F.floor(of_day / MICROS_PER_HOUR).cast("int")


def local_timestamp(micros: Column, minutes: Column) -> Column:
    """Local wall-clock time (no zone) of a UTC microsecond timestamp."""
    shifted = micros + minutes.cast("long") * MICROS_PER_MINUTE
    return F.timestamp_add("MICROSECOND", shifted, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
