"""Sheets: ordered tables with fixed headers, their writer and the reader of the contact sheet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators.registry import with_org_key
from ..session import apart

# Headers in the order of the sheets' columns.
CONTACT_HEADERS = ("Org Key", "Organization", "City", "State", "Website", "Email", "Phone", "Facebook", "Instagram", "Status", "Last Checked", "Source")
#: Rows of one file of a sheet.
FILE_ROWS = 5000


def _day(c: str) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(""))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def production_sheet(productions: DataFrame, orgs: DataFrame) -> DataFrame:
    """The 21 columns of productions in the sheet's order: by start (missing last), organization, then ``seq``.

    Names are the organizations' own; a blank venue is the organization, a blank site the organization's.
    """
    o = orgs.select("org_key", F.col("name").alias("_name"), F.col("website").alias("_site"), *(F.col(c).alias(f"_{c}") for c in ("email", "phone", "facebook", "instagram")))
    p = with_org_key(productions).join(apart(o), "org_key", "left").orderBy(F.asc_nulls_last("start_date"), "organization", "seq")
    start, end = F.col("start_date"), F.col("end_date")
    return p.select(
        F.col("show_title").alias("show"), F.when(_text("venue") != "", F.col("venue")).otherwise(F.col("organization")).alias("venue"), F.coalesce("_name", "organization").alias("organization"),
        text.address_line(F.col("street"), F.col("city"), F.col("state"), F.col("postal"), F.col("country")).alias("address"), "city", "state", "postal", "country",
        _day("start_date").alias("start"), _day("end_date").alias("end"), F.coalesce(dates.run_days(start, end).cast("string"), F.lit("")).alias("run_days"), dates.run_kind(start, end).alias("date_type"), "venue_type",
        F.when(_text("org_website") != "", F.col("org_website")).otherwise(_text("_site")).alias("org_website"), *(_text(f"_{c}").alias(c) for c in ("email", "phone", "facebook", "instagram")),
        F.upper("source").alias("source"), "source_url", "first_seen",
    )


def organization_sheet(orgs: DataFrame) -> DataFrame:
    """The 14 columns of organizations, most productions first, then by name and first row."""
    return orgs.orderBy(F.desc("production_count"), "name", "first_seq").select(
        F.col("name").alias("organization"), "city", "state", "country", F.col("street").alias("address"), "website", "email", "phone", "facebook", "instagram", F.col("production_count").alias("productions"),
        F.array_join(F.transform(F.split("sources", ","), F.upper), ", ").alias("licensors"), "contact_status", F.col("contact_checked").alias("last_checked"),
    )


def contact_sheet(cache: DataFrame) -> DataFrame:
    """The 12 columns of the contact cache by name in lower case, then key."""
    columns = ("org_key", "name", "city", "state", "website", "email", "phone", "facebook", "instagram", "status", "checked")
    return cache.orderBy(F.lower(_text("name")), "org_key").select(*(_text(c).alias(c) for c in columns), F.when(F.coalesce("manual", F.lit(False)), "manual").otherwise("auto").alias("source"))


def preview(productions: DataFrame, orgs: DataFrame) -> DataFrame:
    """Productions and their organizations' names by source and organization."""
    named = with_org_key(productions).join(apart(orgs.select("org_key", F.col("name").alias("_name"))), "org_key", "left")
    return named.orderBy("source", "organization", "seq").select("source", "show_title", F.coalesce("_name", "organization").alias("organization"), "city", "state", _day("start_date").alias("start"), _day("end_date").alias("end"))


def write_sheet(sheet: DataFrame, path: str, headers: tuple[str, ...] = ()) -> None:
    """CSV files in the sheet's order, of at most ``FILE_ROWS`` rows each, every one with its header."""
    named = sheet.toDF(*headers) if headers else sheet
    named.write.mode("overwrite").option("header", True).option("emptyValue", "").option("maxRecordsPerFile", FILE_ROWS).csv(path)


def read_contacts(spark: SparkSession, path: str) -> DataFrame:
    """The contact cache from its sheet: rows without a key go, a blank source is ``auto``, a blank status ``found``,
    and of a repeated key the last row holds. A sheet that lacks one of the headers is empty."""
    raw = spark.read.option("header", True).csv(path)
    names = {c.strip(): c for c in raw.columns}
    columns = ("org_key", "name", "city", "state", "website", "email", "phone", "facebook", "instagram", "status", "checked")
    if not set(CONTACT_HEADERS) <= set(names):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns) + ", manual boolean")
    cell = lambda header: text.strip(F.col(f"`{names[header]}`"))
    rows = raw.select(*(cell(h).alias(c) for h, c in zip(CONTACT_HEADERS, columns)), F.lower(cell("Source")).alias("source"), F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_row"))
    kept = rows.filter(F.col("org_key") != "").withColumn("status", F.when(F.col("status") == "", "found").otherwise(F.col("status"))).withColumn("manual", F.col("source") == "manual")
    others = [*columns[1:], "manual"]
    return kept.groupBy("org_key").agg(F.max_by(F.struct(*others), F.struct("_file", "_row")).alias("_r")).select("org_key", "_r.*")
