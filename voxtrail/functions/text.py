"""Names, words for directions and places, parsed settings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of scenes, which name no object.
SCENE_WORDS = ("background", "wall", "floor", "ceiling", "sky", "ground", "scene", "room", "image", "unknown", "nothing", "none")


def clean_name(raw: Column) -> Column:
    """First line, lower case, without quotes, article and signs, three words at most."""
    line = F.trim(F.regexp_replace(F.element_at(F.split(F.lower(F.trim(raw)), "\n"), 1), "[\"'`]", ""))
    line = F.regexp_replace(line, r"^(a|an|the)\s+", "")
    words = F.filter(F.split(F.trim(F.regexp_replace(line, r"[^a-z0-9 \-]", " ")), r"\s+"), lambda w: w != "")
    return F.array_join(F.slice(words, 1, 3), " ")


def is_bad_name(name: Column) -> Column:
    return (name == "") | name.rlike("|".join(SCENE_WORDS))


def split_tags(tags: Column, separator: str = "|") -> Column:
    return F.filter(F.transform(F.split(tags, f"\\{separator}"), lambda t: F.trim(t)), lambda t: t != "")


def position_9(cx: Column, cy: Column) -> Column:
    """Where a normalised point lies in thirds of the image."""
    across = F.when(cx < 1 / 3, "left").when(cx > 2 / 3, "right").otherwise("center")
    down = F.when(cy < 1 / 3, "top").when(cy > 2 / 3, "bottom").otherwise("middle")
    return F.when((across == "center") & (down == "middle"), "center").otherwise(F.concat_ws("-", down, across))


def direction_words(dx: Column, dy: Column, dz: Column, least_length: float, least_part: float = 0.25) -> Column:
    """Up to two words for the main parts of a displacement: z before x before y where they are equal."""
    n = F.sqrt(dx * dx + dy * dy + dz * dz)
    part = lambda d, order, plus, minus: F.struct((-F.abs(d / n)).alias("size"), F.lit(order).alias("order"), F.when(d > 0, plus).otherwise(minus).alias("word"))
    parts = F.filter(F.array(part(dz, 0, "away", "toward"), part(dx, 1, "right", "left"), part(dy, 2, "down", "up")), lambda p: p["size"] <= -least_part)
    return F.when(n < least_length, "stationary").otherwise(F.array_join(F.slice(F.transform(F.array_sort(parts), lambda p: p["word"]), 1, 2), " and "))


def prefixed(text: Column, prefix: str = "", suffix: str = "") -> Column:
    """Text with a prefix and suffix; the word geometric stays."""
    return F.when(text == "geometric", text).otherwise(F.concat(F.lit(prefix), text, F.lit(suffix)))


def parse_scalar(s: str):
    """A literal of a setting: true, false, none, a number, or the text."""
    low = s.strip().lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("none", "null"):
        return None
    for kind in (int, float):
        try:
            return kind(low)
        except ValueError:
            continue
    return s.strip()


def parse_settings(s: str) -> dict:
    """key=value, comma-separated."""
    return {k.strip(): parse_scalar(v) for k, v in (x.split("=", 1) for x in s.split(",") if "=" in x)}


# Extensions by kind of input.
VIDEO_PATHS, IMAGE_PATHS = r"\.(mp4|mov|avi|mkv|webm)$", r"\.(jpg|jpeg|png|bmp|webp|tif|tiff)$"


def input_kind(path: Column) -> Column:
    """video, image, colmap or unknown, from a path alone."""
    low = F.lower(path)
    return F.when(low.rlike(VIDEO_PATHS), "video").when(low.rlike(IMAGE_PATHS), "image").when(low.rlike(r"(cameras\.(bin|txt)|/sparse)$"), "colmap").otherwise("unknown")
