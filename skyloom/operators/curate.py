"""Samples with places, cohorts and injected tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.text import share


def allocation_audit(allocated: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: allocated, missing_disk, missing_labels (of those on disk), copied."""
    joined = allocated.select("stem").join(images.select("stem").distinct().withColumn("i", F.lit(1)), "stem", "left").join(labels.select("stem").distinct().withColumn("l", F.lit(1)), "stem", "left")
    has_image, has_label = F.col("i").isNotNull(), F.col("l").isNotNull()
    return joined.agg(
        F.count("*").alias("allocated"),
        F.count_if(~has_image).alias("missing_disk"),
        F.count_if(has_image & ~has_label).alias("missing_labels"),
        F.count_if(has_image & has_label).alias("copied"),
    )


def copy_manifest(allocated: DataFrame, images: DataFrame, labels: DataFrame) -> DataFrame:
    """(stem, split, image_path, label_path) of the files to copy (K08); of a repeated stem the greatest path counts."""
    one = lambda df, name: df.groupBy("stem").agg(F.max("path").alias(name))
    return allocated.select("stem", "split").join(one(images, "image_path"), "stem").join(one(labels, "label_path"), "stem")


def injected(walked: DataFrame, dropped: DataFrame, missing: DataFrame, loaded: DataFrame, orphans: bool = True) -> DataFrame:
    """Ghosts (dropped tiles) and, if asked for, orphans (tiles without a footprint that no cohort has)."""
    ghosts = walked.join(dropped.select("stem").distinct(), "stem", "left_semi").withColumn("tags", F.array(F.lit("ghost")))
    if not orphans:
        return ghosts
    rest = walked.join(dropped.select("stem").distinct(), "stem", "left_anti").join(missing.select("stem").distinct(), "stem", "left_semi").join(loaded.select("stem").distinct(), "stem", "left_anti")
    return ghosts.unionByName(rest.withColumn("tags", F.array(F.lit("excluded_orphan"), F.lit("no_footprint"))))


def with_groups(samples: DataFrame, missing: DataFrame) -> DataFrame:
    """Add split and map_group to samples(stem, tags); tiles without a footprint get a tag for it."""
    flagged = samples.join(missing.select("stem").distinct().withColumn("__m", F.lit(True)), "stem", "left")
    orphan = F.coalesce(F.array_contains("tags", "excluded_orphan"), F.lit(False))
    lost = F.col("__m").isNotNull() & ~orphan
    first = F.coalesce(F.get("tags", F.lit(0)), F.lit("unknown"))
    split = F.when(orphan, "excluded").otherwise(first)
    return flagged.withColumns(
        {
            "split": split,
            "map_group": F.when(orphan, "excluded_orphan").when(lost, "no_footprint").otherwise(split),
            "tags": F.when(lost, F.array_append(F.coalesce("tags", F.array().cast("array<string>")), F.lit("no_footprint"))).otherwise(F.col("tags")),
        }
    ).drop("__m")


def campaign_year(campaign: Column) -> Column:
    """The year of an all-digit campaign, null below 1 or above 9999."""
    digits = F.when(campaign.rlike("^[0-9]{1,4}$"), campaign.cast("int"))
    return F.when(digits > 0, digits)


def with_places(samples: DataFrame, footprints: DataFrame) -> DataFrame:
    """Add lon, lat (mean of the corners), campaign ("Unknown" without a footprint), campaign_year and timestamp.

    The timestamp is that of the campaign year's first day, in seconds and UTC; campaigns that are not digits have none.
    """
    places = footprints.groupBy("stem").agg(F.max_by(F.struct("lon", "lat", F.coalesce("campaign", F.lit("0")).alias("campaign")), "ord").alias("f"))
    joined = samples.join(places, "stem", "left")
    campaign = F.coalesce("f.campaign", F.lit("Unknown"))
    return joined.withColumns({"lon": F.col("f.lon"), "lat": F.col("f.lat"), "campaign": campaign, "campaign_year": campaign_year(campaign), "timestamp": _first_day(campaign)}).drop("f")


def _first_day(campaign: Column) -> Column:
    """Seconds from 1970 to January 1 of a year of one to four digits."""
    year = F.when(campaign.rlike("^[0-9]{1,4}$") & ~campaign.rlike("^0+$"), campaign.cast("int"))
    return (F.datediff(F.make_date(year, F.lit(1), F.lit(1)), F.lit("1970-01-01").cast("date")) * 86400.0).cast("double")


def campaign_report(samples: DataFrame) -> DataFrame:
    """Samples by campaign, in total and for each split, in the order of the report: all, the splits, then what is on the map alone."""
    counts = samples.groupingSets([["split", "campaign"], ["campaign"]], "split", "campaign").agg(F.grouping("split").alias("all"), F.coalesce(F.col("split"), F.lit("total")).alias("cohort"), F.count("*").alias("n"))
    place = F.when(F.col("all") == 1, 0).when(F.col("cohort").isin("ghost", "excluded"), 2).otherwise(1)
    return counts.select(place.cast("int").alias("part"), "cohort", "campaign", "n").orderBy("part", "cohort", "campaign")


def fg_bg(samples: DataFrame, boxes: str = "n_boxes") -> DataFrame:
    """Foreground, background and boxes by split and in total."""
    n = F.coalesce(F.col(boxes), F.lit(0))
    return samples.groupingSets([["split"], []], "split").agg(
        F.coalesce(F.col("split"), F.lit("total")).alias("cohort"), F.count_if(n > 0).alias("fg"), F.count_if(n == 0).alias("bg"), F.sum(n).cast("long").alias("boxes")
    ).drop("split")


def background_ratio(stats: DataFrame) -> DataFrame:
    """fg_bg() with the background's percent of each cohort."""
    return stats.withColumn("bg_pct", F.round(share(F.col("bg"), F.col("fg") + F.col("bg")), 6))


def by_period(samples: DataFrame) -> DataFrame:
    """Samples with a place, and period: newest, older or unknown against newest_year."""
    year, newest = F.col("campaign_year"), F.col("newest_year")
    known = (year > 0) & (newest > 0)
    period = F.when(known & (year >= newest), "newest").when(known & (year < newest), "older").otherwise("unknown")
    return samples.where("lon is not null and lat is not null").withColumn("period", period)


def newest_and_older(samples: DataFrame) -> DataFrame:
    """One row: the newest year, and the newest before it (else the year before, or 0)."""
    years = samples.where(F.col("campaign_year") > 0).select(F.col("campaign_year").alias("y"))
    top = years.agg(F.coalesce(F.max("y"), F.lit(0)).alias("newest_year"))
    older = years.crossJoin(F.broadcast(top)).where(F.col("y") < F.col("newest_year")).agg(F.max("y").alias("o"))
    fallback = F.when(F.col("newest_year") > 0, F.col("newest_year") - 1).otherwise(0)
    return top.crossJoin(older).select("newest_year", F.coalesce("o", fallback).alias("older_year"))
