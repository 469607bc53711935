"""File-name and path expressions, all inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker of processed images, its pattern up to the extension, and image extensions.
PROCESSED = "_"
TAG = r"-gigapixel-[^.]+"
IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "tif", "tiff")
DJVU = ".djvu"


def is_processed(name: Column) -> Column:
    return F.startswith(name, F.lit(PROCESSED))


def is_djvu(name: Column) -> Column:
    """Case-sensitive."""
    return F.endswith(name, F.lit(DJVU))


def is_image(name: Column) -> Column:
    """Any case. Such names are never DjVu files."""
    return F.lower(name).rlike(rf"\.({'|'.join(IMAGE_EXTENSIONS)})\z")


def base_name(name: Column) -> Column:
    """The original that a processed image was made from; other names unchanged."""
    return F.when(is_processed(name), F.regexp_replace(F.substr(name, F.lit(2)), rf"{TAG}(\.[^.]+)\z", "$1")).otherwise(name)


def tag(name: Column) -> Column:
    """The processing tag of a processed image, or an empty string."""
    return F.when(is_processed(name), F.regexp_extract(name, rf"({TAG})\.[^.]+\z", 1)).otherwise(F.lit(""))


def extension(name: Column) -> Column:
    """Lower-case, without the dot; empty for none and for names that only begin with a dot."""
    return F.lower(F.regexp_extract(name, r"(?s).\.([^.]+)\z", 1))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?s)(?<=.)\.[^.]+\z", "")


def joined(*parts: Column | str) -> Column:
    return F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def relative(path: Column, root: str) -> Column:
    """path below root; null if it isn't."""
    base = root.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(base)), F.substr(path, F.lit(len(base) + 1)))


def path_order(relative_path: Column) -> Column:
    """A key that sorts paths by their components, not by their characters."""
    return F.split(relative_path, "/")


def pictures_dir(relative_path: Column, destination: str, wanted: Column) -> Column:
    """Folder of a document's page pictures beside its output, or null unless wanted."""
    folder = F.regexp_replace(relative_path, r"(?s)[^/]*\z", "")
    name = F.regexp_extract(relative_path, r"(?s)([^/]*)\z", 1)
    return F.when(wanted, F.concat(F.lit(destination.rstrip("/") + "/"), folder, stem(name), F.lit(".page_pics")))


def picture_name(box: Column, ext: Column) -> Column:
    return F.format_string("page_%04d.%s", box.cast("int"), ext)
