"""Text, time and array scalars as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Templates and synonyms that language rows are filled from.
PARAPHRASES = ("{t}.", "Please {tl}.", "Your task: {tl}.", "Go ahead and {tl}.", "The goal is to {tl}.")
SYNONYMS = {"sort": "organize", "staple": "fasten", "pick up": "grab", "place": "put", "move": "transport", "workbench": "work surface"}


def fill(template: Column, fields: dict[str, Column]) -> Column:
    """Template with its known placeholders filled; unknown ones stay as they are."""
    out = template
    for name, value in fields.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def paraphrases(task: Column, n: int) -> Column:
    """Up to n different rephrasings of a task by sentence frames, with and without synonyms."""
    base = F.regexp_replace(F.trim(task), r"\.+$", "")
    lowered = F.concat(F.lower(F.substring(base, 1, 1)), F.substr(base, F.lit(2)))
    swapped = lowered
    for a, b in SYNONYMS.items():
        swapped = F.replace(swapped, F.lit(a), F.lit(b))
    capital = F.concat(F.upper(F.substring(swapped, 1, 1)), F.lower(F.substr(swapped, F.lit(2))))
    variants = []
    for template in PARAPHRASES:
        variants.append(fill(F.lit(template), {"t": base, "tl": lowered}))
        variants.append(F.when(swapped != lowered, fill(F.lit(template), {"t": capital, "tl": swapped})))
    return F.slice(F.array_distinct(F.filter(F.array(*variants), lambda x: x.isNotNull())), 1, n)


def normalised(label: Column) -> Column:
    return F.translate(F.lower(F.trim(F.coalesce(label, F.lit("")))), " -", "__")


def disagree(guess: Column, label: Column) -> Column:
    """Whether a guess names another task; unknown never disagrees."""
    a, b = normalised(guess), normalised(label)
    return (a != "") & (a != b) & (b != "unknown")


def spot_check(key: Column, rate: float) -> Column:
    """Deterministic sample by the hash of a key."""
    if rate <= 0:
        return F.lit(False)
    if rate >= 1:
        return F.lit(True)
    return F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double") / 4294967295.0 < rate


def prompts(task: Column, stop_words: tuple[str, ...] = ("with", "from", "into", "onto", "then", "that", "this")) -> Column:
    words = F.filter(F.split(F.lower(task), "[^a-z0-9]+"), lambda w: (F.length(w) > 3) & ~w.isin(*stop_words))
    return F.array_distinct(words)


def cost_usd(input_tokens: Column, output_tokens: Column, input_price: float, output_price: float) -> Column:
    return F.round(input_tokens / 1e6 * input_price + output_tokens / 1e6 * output_price, 6)


def annotation_cost(segments: Column, frames_per_call: int, judged: Column, per_image: float, per_call: float) -> Column:
    return F.round(segments * (frames_per_call * per_image + per_call) + judged * per_call, 4)


def safe_filename(name: Column) -> Column:
    ascii_only = F.regexp_replace(name, r"[^\x20-\x7e]", "")
    return F.regexp_replace(F.regexp_replace(ascii_only, r"[^A-Za-z0-9._-]", "_"), "_{2,}", "_")


def safe_prefix(path: Column) -> Column:
    return F.array_join(F.filter(F.split(path, "/"), lambda p: ~p.isin("", ".", "..")), "/")


def url_filename(url: Column, default: str = "download") -> Column:
    path = F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/(.*)$", 1)
    last = F.element_at(F.split(path, "/"), -1)
    return F.when(F.coalesce(last, F.lit("")) == "", F.lit(default)).otherwise(F.coalesce(F.try_url_decode(last), last))


def drive_download(url: Column) -> Column:
    """A file share link as a download link; others as they are."""
    found = F.regexp_extract(url, r"drive\.google\.com/(?:file/d/|open\?id=|uc\?.*id=)([A-Za-z0-9_-]+)", 1)
    return F.when(found != "", F.concat(F.lit("https://drive.google.com/uc?export=download&id="), found)).otherwise(url)


def expires_seconds(text: Column) -> Column:
    """'90', '90s', '15m', '12h' or '7d' in seconds; null for anything else."""
    number = F.regexp_extract(F.trim(text), r"^(\d+)\s*[smhd]?$", 1)
    unit = F.regexp_extract(F.trim(text), r"^\d+\s*([smhd]?)$", 1)
    factor = F.when(unit == "m", 60).when(unit == "h", 3600).when(unit == "d", 86400).otherwise(1)
    return F.when(number != "", F.try_to_number(number, F.lit("999999999999")).cast("long") * factor)


def epoch_ms(text: Column) -> Column:
    """ISO 8601 text, Z included, as milliseconds; null if it is none."""
    return F.unix_millis(F.try_to_timestamp(text))


def age_days(now: Column, then: Column) -> Column:
    """Whole days that have passed, by elapsed time."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(then)) / 86400)


def sorted_json(m: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def canonical_prefix(episode: Column, version: Column) -> Column:
    return F.format_string("canonical/%s/v%d", episode, version.cast("int"))


def even_indices(n: Column, most: Column) -> Column:
    """At most so many evenly spaced different indices of 0..n-1, first and last among them; all if most is null or not less."""
    every = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    steps = F.sequence(F.lit(0).cast("long"), F.greatest(most.cast("long") - 1, F.lit(0).cast("long")))
    spread = F.transform(steps, lambda i: F.when(most <= 1, F.lit(0).cast("long")).otherwise(F.bround(i * (n - 1) / F.greatest(most - 1, F.lit(1))).cast("long")))
    return F.when(most.isNull() | (n <= most), every).otherwise(F.array_distinct(spread))


def bits_to_long(bits: Column) -> Column:
    """An array of booleans, the highest bit first."""
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b.cast("long")))


def mean_hash(cells: Column) -> Column:
    """Perceptual hash of an array of grey means: a bit for each above their mean."""
    mean = F.aggregate(cells, F.lit(0.0), lambda s, x: s + x) / F.size(cells)
    return bits_to_long(F.transform(cells, lambda x: x > mean))
