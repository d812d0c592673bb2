"""Plate, well and perturbation keys, file names, labels: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel numbers of the acquisition protocol.
CHANNELS = {1: "Mito", 2: "Golgi", 3: "Brightfield", 4: "Syto", 5: "ER", 6: "Hoechst"}

# Grammar of image file names (row, column, field, plane, channel).
IMAGE_NAME = r"^\d(\d{2})\d(\d{2})-(\d)-\d{3}(\d{3})(\d{3})\.tif"


def clean_number(c: Column) -> Column:
    """NaN becomes null; the rule applied to every floating column at the scan."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def plate_number(c: Column) -> Column:
    """The plate's number; null for any string that names no plate.

    Blanks and letter case around the key are ignored, as are one leading ``P``
    and leading zeros.  More than 18 digits name no plate.
    """
    digits = F.regexp_extract(F.upper(F.trim(c)), r"^P?0*(\d{1,18})$", 1)
    return F.when(digits != "", digits.cast("long"))


def well_name(c: Column) -> Column:
    """``A01`` .. ``H12`` in capitals; null for any string that names no well."""
    well = F.upper(F.trim(c))
    return F.when(well.rlike("^[A-H](0[1-9]|1[0-2])$"), well)


def perturbation_key(c: Column) -> Column:
    return F.upper(F.trim(c))


def well_label(row: Column, column: Column) -> Column:
    """Row and column numbers from 1 to ``A01``; rows beyond 26 get two letters."""
    one = F.char(F.lit(64) + row)
    two = F.concat(F.char(F.lit(64) + F.floor((row - 1) / 26).cast("int")), F.char(F.lit(65) + (row - 1) % 26))
    return F.concat(F.when(row <= 26, one).otherwise(two), F.lpad(column.cast("string"), 2, "0"))


def plate_text(c: Column) -> Column:
    """Plate as text without leading ``P`` and zeros, ``0`` when nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(F.trim(c), "^P*0*", ""), F.lit("")), F.lit("0"))


def plate_from_path(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"_P(\d+)", 1), F.lit(""))


def channel_name(number: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CHANNELS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, number.cast("int")), number.cast("string"))


def image_name_part(c: Column, part: str) -> Column:
    """row, column, field, plane or channel of an image file name; null if it does not match."""
    at = {"row": 1, "column": 2, "field": 3, "plane": 4, "channel": 5}[part]
    return F.nullif(F.regexp_extract(c, IMAGE_NAME, at), F.lit("")).cast("int")


def mask_name(mask: Column, image: Column) -> Column:
    return F.coalesce(mask, F.regexp_replace(image, r"\.tiff?$", ".png"))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z0-9_\-]", "_")


def cluster_label(c: Column) -> Column:
    return F.format_string("Cluster_%02d", c.cast("int"))


def plain_plate(c: Column) -> Column:
    """Plate key without blanks, case and leading zeros; a leading ``p`` is kept."""
    low = F.lower(F.trim(c))
    bare = lambda x: F.coalesce(F.nullif(F.ltrim(x, F.lit("0")), F.lit("")), F.lit("0"))
    return F.when(low.startswith("p"), F.concat(F.lit("p"), bare(F.substring(low, F.lit(2), F.length(low))))).otherwise(bare(low))


def dashed_name(c: Column) -> dict[str, Column]:
    """row, column and site of names like ``001003-1-001002004.tiff``; null where a part is no number."""
    part = lambda i: F.get(F.split(F.replace(c, F.lit(".tiff")), "-"), F.lit(i))
    number = lambda x: x.try_cast("int")
    return {"row": number(F.substring(part(0), 1, 3)), "column": number(F.substring(part(0), 4, 3)), "site": number(part(1))}


def compartment_rank(c: Column) -> Column:
    """0 cells, 1 cytoplasm, 2 nuclei, 3 other, by a part of the name in any case."""
    low = F.lower(c)
    return F.when(low.contains("cells"), 0).when(low.contains("cytoplasm"), 1).when(low.contains("nuclei"), 2).otherwise(3)


def label_is(c: Column, exact: str | None = None, prefix: str | None = None, without: str | None = None, names: list[str] | None = None) -> Column:
    """Whether a label equals ``exact``, starts with ``prefix``, does not start with ``without`` and is one of ``names`` (None: any)."""
    out = c.isNotNull()
    for wanted, test in ((exact, lambda v: c == v), (prefix, c.startswith), (without, lambda v: ~c.startswith(v)), (names, c.isin)):
        out = out if wanted is None else out & test(wanted)
    return out
