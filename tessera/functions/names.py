"""Names and paths as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions of slide files, told by case.
EXTENSIONS = ("svs", "tif", "tiff", "ndpi", "vms", "vmu", "scn", "mrxs", "bif", "svslide", "dcm")


def sample_id(path: Column) -> Column:
    """The file name up to its first dot."""
    return F.substring_index(F.element_at(F.split(path, "/"), -1), ".", 1)


def is_slide(path: Column) -> Column:
    return F.regexp_like(path, F.lit(r"\.(" + "|".join(EXTENSIONS) + r")$"))


def tile_name(slide_id: Column, x: Column, y: Column, size: Column, magnification: Column) -> Column:
    return F.format_string("%s_%d_%d_size_%d_mag_%d.png", slide_id, x.cast("int"), y.cast("int"), size.cast("int"), magnification.cast("int"))


def is_tumour(barcode: Column) -> Column:
    """1 or 0 from the digits of a barcode's fourth field: 11 and more are normal tissue. Null where there is none."""
    digits = F.regexp_replace(F.get(F.split(barcode, "-"), 3), "[^0-9]", "")
    number = F.when(F.length(digits) > 0, digits.cast("int"))
    return F.when(number >= 11, 0).when(number.isNotNull(), 1)
