"""Column expressions on names, paths, ids, clocks and prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Content type by file suffix.
CONTENT_TYPES = {
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".gif": "image/gif",
    ".bmp": "image/bmp",
    ".webp": "image/webp",
    ".tiff": "image/tiff",
    ".tif": "image/tiff",
    ".heic": "image/heic",
    ".heif": "image/heif",
}
OTHER_CONTENT = "application/octet-stream"

# Suffixes an image folder is searched for.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tif", ".tiff", ".gif", ".heic")


def trim_slashes(path: Column) -> Column:
    return F.regexp_replace(path, "^/+|/+$", "")


def image_address(directory: Column, filename: Column) -> Column:
    """``folder/name``, or the bare name at the root."""
    folder = trim_slashes(F.coalesce(directory, F.lit("")))
    return F.when(folder == "", filename).otherwise(F.concat_ws("/", folder, filename))


def canonical_directory(path: Column) -> Column:
    """``/`` or ``/a/b``; null for a path with a ``..`` part or a NUL byte."""
    clean = trim_slashes(F.trim(path))
    bad = F.array_contains(F.split(clean, "/"), "..") | F.contains(clean, F.lit("\x00"))
    return F.when(~bad, F.concat(F.lit("/"), clean))


def split_ref(ref: Column) -> tuple[Column, Column]:
    """Organisation and name of ``org/name``; both null unless both parts are there."""
    org = F.trim(F.split_part(F.trim(ref), F.lit("/"), F.lit(1)))
    name = F.trim(F.regexp_extract(F.trim(ref), "^[^/]*/(.*)$", 1))
    good = (org != "") & (name != "")
    return F.when(good, org), F.when(good, name)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot is part of the name."""
    name = base_name(path)
    short = F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)
    return F.when(short == "", name).otherwise(short)


def suffix(path: Column) -> Column:
    """Last suffix in lower case with its dot, empty when there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1))


def content_type(filename: Column) -> Column:
    """X39."""
    known = F.create_map(*[F.lit(v) for kv in CONTENT_TYPES.items() for v in kv])
    return F.coalesce(F.element_at(known, suffix(filename)), F.lit(OTHER_CONTENT))


def track_id(attributes: Column) -> Column:
    """The track id attribute when it is a whole number."""
    raw = F.element_at(attributes, "track_id")
    return F.when(raw.rlike("^[0-9]+$"), raw.try_cast("bigint"))


def record_identity(cursor: Column) -> Column:
    """The first seven entries of the JSON list inside the cursor, else the cursor itself.

    Entries stay as their JSON text, so numbers and strings compare as written.
    """
    padded = F.rpad(cursor, (F.ceil(F.length(cursor) / 4) * 4).cast("int"), "=")
    text = F.try_to_binary(F.translate(padded, "-_", "+/"), F.lit("base64"))
    decoded = F.from_json(F.try_validate_utf8(text.cast("string")), "array<string>")
    keyed = F.when(F.size(decoded) >= 7, F.slice(decoded, 1, 7)).otherwise(F.array(cursor))
    return F.when(F.coalesce(cursor, F.lit("")) != "", F.coalesce(keyed, F.array(cursor)))


def capture_time(capture_ns: Column) -> Column:
    """A timestamp from nanoseconds since the epoch; null unless positive."""
    return F.when(capture_ns > 0, F.timestamp_micros(F.floor(capture_ns / 1000).cast("bigint")))


def capture_latency_ms(received_ns: Column, capture_ns: Column) -> Column:
    """X42."""
    return F.when(capture_ns > 0, (received_ns - capture_ns) / 1e6)


def usd(micro_usd: Column) -> Column:
    """Exact display value of an integer micro-USD amount."""
    return (micro_usd.cast("decimal(18,0)") / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(18,6)")


def frame_stride(native_fps: Column, sample_fps: Column) -> Column:
    """Keep every n-th frame; the ratio is rounded half to even and at least 1."""
    return F.greatest(F.lit(1), F.bround(native_fps / F.greatest(sample_fps, F.lit(0.01)))).cast("bigint")


def frame_count(seconds: Column, fps: Column) -> Column:
    """X44."""
    return F.floor(seconds * fps)
