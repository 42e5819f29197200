"""Column functions on file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The extension sets by name. "images_exact" is matched with case.
EXTENSIONS = {
    "images": ("jpg", "jpeg", "png", "bmp", "tiff"),
    "images_wide": ("jpg", "jpeg", "png", "bmp", "gif", "tiff", "webp"),
    "images_exact": ("jpg", "jpeg", "png", "bmp", "tiff"),
    "images_web": ("jpg", "jpeg", "png", "bmp", "gif"),
    "jpg_exact": ("jpg",),
    "png": ("png",),
}
CASE_SENSITIVE = {"images_exact", "jpg_exact"}
MASK_SUFFIX = "_mask"


def file_name(path: Column) -> Column:
    """The part after the last slash."""
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """File name without its extension; a leading dot does not start one."""
    return F.regexp_extract(file_name(path), r"^(.+?)(\.[^.]*)?$", 1)


def extension(path: Column) -> Column:
    """The extension with its dot, or an empty string."""
    return F.regexp_extract(file_name(path), r"^(.+?)(\.[^.]*)?$", 2)


def parent(path: Column) -> Column:
    """The part before the last slash, or an empty string."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def trim_slashes(path: Column) -> Column:
    return F.regexp_replace(path, "/+$", "")


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def path_only(uri: Column) -> Column:
    """Drop scheme and authority, so that ``file:/a``, ``file:///a`` and ``/a`` are equal."""
    return F.regexp_replace(uri, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def relative_path(path: Column, root: str) -> Column:
    """``path`` below ``root``; either may be a URI, and ``root`` may end in slashes."""
    base = trim_slashes(path_only(F.lit(root)))
    return F.substr(path_only(path), F.length(base) + 2)


def category(relative: Column) -> Column:
    """The directory part of a relative path."""
    return parent(relative)


def replace_root(path: Column, old: str, new: str) -> Column:
    return F.concat_ws("/", trim_slashes(F.lit(new)), relative_path(path, old))


def has_extension(path: Column, named_set: str = "images") -> Column:
    """Does the file name end in one of the set's extensions?"""
    text = path if named_set in CASE_SENSITIVE else F.lower(path)
    test = F.lit(False)
    for ext in EXTENSIONS[named_set]:
        test = test | F.endswith(text, F.lit("." + ext))
    return test


def is_mask(path: Column) -> Column:
    return F.contains(file_name(path), F.lit(MASK_SUFFIX))


def image_stem(path: Column) -> Column:
    """The stem that an image and its mask have in common."""
    return F.regexp_replace(stem(path), MASK_SUFFIX + "$", "")


def mask_path(path: Column) -> Column:
    """Where the mask of an image lies: ``_mask`` before the extension."""
    folder = F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)
    return F.concat(folder, stem(path), F.lit(MASK_SUFFIX), extension(path))


def underscored(path: Column) -> Column:
    """Spaces replaced by underscores."""
    return F.replace(path, F.lit(" "), F.lit("_"))


def suffixed(path: Column, kind: str) -> Column:
    """``{stem}_{kind}{ext}``"""
    return F.concat(stem(path), F.lit("_" + kind), extension(path))


def png_named(path: Column, kind: Column) -> Column:
    """``{stem}_{kind}.png`` for a file ``{stem}.png``; others keep their extension before ``.png``, so that names stay distinct."""
    ext = extension(path)
    return F.concat(stem(path), F.lit("_"), kind, F.when(ext == ".png", F.lit("")).otherwise(ext), F.lit(".png"))


def png_prefixed(path: Column, kind: str) -> Column:
    """``{kind}_{name}``, followed by ``.png`` unless it ends so."""
    name = prefixed(path, kind)
    return F.when(F.endswith(name, F.lit(".png")), name).otherwise(F.concat(name, F.lit(".png")))


def kept_prefixed(path: Column, kind: str) -> Column:
    """``{kind}_{name}``, followed by ``.png`` unless files of its extension can be written."""
    name = prefixed(path, kind)
    return F.when(F.lower(name).rlike(r"\.(png|bmp|jpg|jpeg)$"), name).otherwise(F.concat(name, F.lit(".png")))


def prefixed(path: Column, kind: str) -> Column:
    """``{kind}_{name}``"""
    return F.concat(F.lit(kind + "_"), file_name(path))


def numbered(index: Column, ext: Column) -> Column:
    """``image_0001.jpg``: at least four digits."""
    return F.format_string("image_%04d%s", index, ext)
