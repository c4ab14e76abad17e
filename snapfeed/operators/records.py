"""JSON records: payload decode and gate, shallow merge, field defaults, arrays, and the
model description renderer (SRC-3, SRC-4, MAP-1, JSON-1, ARR-1, ARR-2, STR-16, STR-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.cleaners import clean_description
from ..functions.dates import display_date
from ..functions.text import format_1dp, format_int, html_escape, is_blank, strip_tags, trim_all
from ..functions.urls import media_url


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- SRC-3 / SRC-4 ----------------------------------------------------------------------------------

def decode_payload(col, schema: str) -> Column:
    """SRC-3: typed decode; malformed input gives null fields (PERMISSIVE)."""
    return F.from_json(_c(col), schema, {"mode": "PERMISSIVE"})


def split_payloads(df: DataFrame, payload: str = "payload", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC-4: (good, bad) payloads.  Bad: invalid JSON, a non-null ``errors`` key, or
    ``data.models.items`` missing, null or a scalar (an object is an array of the source's decoder).  The
    tests go by JSON type, not by text.  ``strict`` raises on the first bad row
    (the source aborts the whole run); otherwise bad rows are quarantined with a reason."""
    p = _c(payload)
    # inside brackets, text behind the value makes the whole invalid or a second element
    decoded = F.try_parse_json(F.concat(F.lit("["), p, F.lit("]")))
    part = lambda path: F.try_variant_get(decoded, path, "variant")
    errors, items = (F.schema_of_variant(part(f"$[0].{path}")) for path in ("errors", "data.models.items"))
    reason = (F.when(part("$[0]").isNull() | part("$[1]").isNotNull(), F.lit("invalid json"))
              .when(errors.isNotNull() & (errors != "VOID"), F.concat(F.lit("errors: "), F.get_json_object(p, "$.errors")))
              .when(items.isNull() | ~items.rlike("^(ARRAY|OBJECT)<"), F.lit("unexpected format")))
    tagged = df.withColumn("reason", reason)
    bad = tagged.where(F.col("reason").isNotNull())
    good = tagged.where(F.col("reason").isNull()).drop("reason")
    if strict:
        bad = bad.withColumn("reason", F.raise_error(F.concat(F.lit("API request failed: "), F.col("reason"))))
    return good, bad


# --- MAP-1 -------------------------------------------------------------------------------------------

def merge_records(base_json, detail_json) -> Column:
    """MAP-1: shallow merge of two JSON objects as ``map<string,string>``: every key present
    in the detail wins (a present null included), other base keys stay; nested values are
    replaced whole.  Missing detail -> base unchanged."""
    b = F.from_json(_c(base_json), "map<string,string>")
    d = F.from_json(_c(detail_json), "map<string,string>")
    merged = F.map_concat(F.map_filter(b, lambda k, v: ~F.map_contains_key(d, k)), d)
    return F.when(d.isNull(), b).otherwise(merged)


# --- JSON-1 / ARR ---------------------------------------------------------------------------------------

def with_default(col, default: str = "Unknown") -> Column:
    return F.coalesce(_c(col), F.lit(default))


def names_of(arr) -> Column:
    """ARR-1: array<struct<name,...>> -> array<string>."""
    return F.transform(_c(arr), lambda x: x["name"])


def feature_flags(mmu, ai, club, nsfw) -> Column:
    """ARR-2: truthy flags -> ordered labels."""
    pairs = [(mmu, "Multi-Material"), (ai, "AI Generated"), (club, "Premium"), (nsfw, "NSFW")]
    return F.array_compact(F.array(*[F.when(F.coalesce(_c(c), F.lit(False)), F.lit(lab)) for c, lab in pairs]))


# --- STR-16 / STR-15 ---------------------------------------------------------------------------------------

def describe_model(m: dict) -> Column:
    """STR-16: summary, cleaned description, stats, metadata, or the fallback sentence.

    ``m`` maps logical field names to columns: summary, description, likes, downloads,
    rating, published (timestamp), path (array<string>), tags (array<string>), flags
    (array<string>), user (string), verified (bool), level (int)."""
    summary = trim_all(strip_tags(m["summary"]))
    p_summary = F.when(~is_blank(m["summary"]) & ~is_blank(summary),
                       F.concat(F.lit("<p>"), html_escape(summary), F.lit("</p>")))
    desc = m["description_clean"] if "description_clean" in m else clean_description(m["description"])
    p_desc = F.when(~is_blank(m["description"]) & ~is_blank(desc), desc)
    stats = F.concat_ws(", ",
                        F.when(m["likes"] > 0, F.concat(format_int(m["likes"]), F.lit(" likes"))),
                        F.when(m["downloads"] > 0, F.concat(format_int(m["downloads"]), F.lit(" downloads"))),
                        F.when(m["rating"] > 0, F.concat(format_1dp(m["rating"]), F.lit("/5.0 rating"))))
    p_stats = F.when(stats != "", F.concat(F.lit("<p>Stats: "), stats, F.lit("</p>")))
    creator = F.concat(m["user"],
                       F.when(F.coalesce(m["verified"], F.lit(False)), F.lit(" (Verified)")).otherwise(F.lit("")),
                       F.when(F.coalesce(m["level"], F.lit(0)) != 0,
                              F.concat(F.lit(" - Level "), m["level"].cast("string"))).otherwise(F.lit("")))
    meta = F.concat_ws(" | ",
                       F.when(m["published"].isNotNull(), F.concat(F.lit("Published: "), display_date(m["published"]))),
                       F.when(F.size(m["path"]) > 0, F.concat(F.lit("Category: "), F.array_join(m["path"], " > "))),
                       F.when(F.size(m["tags"]) > 0, F.concat(F.lit("Tags: "), F.array_join(m["tags"], ", "))),
                       F.when(F.size(m["flags"]) > 0, F.concat(F.lit("Features: "), F.array_join(m["flags"], ", "))),
                       F.when(m["user"].isNotNull(), F.concat(F.lit("Creator: "), creator)))
    p_meta = F.when(meta != "", F.concat(F.lit("<p>"), meta, F.lit("</p>")))
    body = F.concat_ws("", p_summary, p_desc, p_stats, p_meta)
    return F.coalesce(F.nullif(body, F.lit("")), F.lit(rules.MODEL_FALLBACK_SENTENCE))


def render_model(name, image_path, description_html) -> Column:
    """STR-15 (JSON models): wrapper, optional image, description."""
    img = F.when(~is_blank(image_path), F.concat(
        F.lit('<img src="'), html_escape(media_url(image_path)), F.lit('" alt="'), html_escape(_c(name)), F.lit('">')))
    return F.concat(F.lit(f'<div class="{rules.JSON_CONTENT_CLASS}">'), F.coalesce(img, F.lit("")),
                    F.coalesce(_c(description_html), F.lit("")), F.lit("</div>"))
