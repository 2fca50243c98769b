"""Sky masks of all devices and days in a set of images.

Stage results that are read more than once become tables (`stage_table`): lineage ends
there, and a lost executor costs one stage, not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyframes.operators import mask
from skyframes.session import stage_table


def regions(images: DataFrame) -> DataFrame:
    """Candidate sky regions, an image row each (device_id, day, height, width, n_regions, start, length, region, area)."""
    return stage_table(mask.sky_regions(mask.raw_mask(mask.pixel_hits(images))), "regions")


def kept_regions(images: DataFrame, found: DataFrame, least: float = 0.3) -> DataFrame:
    """Regions left after comparing their brightness with region 1."""
    several = found.where("n_regions > 1")
    return mask.decided_regions(found, mask.region_correlation(mask.region_sums(images, several), least))


def sky_mask(images: DataFrame) -> DataFrame:
    """Final masks, an image row each (device_id, day, height, width, start, length)."""
    return stage_table(mask.final_mask(kept_regions(images, regions(images))), "sky_mask")
