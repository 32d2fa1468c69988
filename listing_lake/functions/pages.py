"""Landed HTML pages: visible text, identity, outcome, and the state document inside the page."""

from __future__ import annotations

import json
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_lake.functions.text import DETAIL_PATTERNS, fold_accents, parse_distance_m

# Markers in the page, keys of its state document and the published states.
STATE_PATTERN = r"(?s)_n\.ctx\.r=(\{.*?\});_n\.ctx\.r\.assets\.manifest="
CANONICAL_TAG = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']canonical[\"'][^>]*>"
OG_URL_TAG = r"(?is)<meta\b[^>]*\bproperty\s*=\s*[\"']og:url[\"'][^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']([^\"']*)[\"']"
CONTENT = r"(?is)\bcontent\s*=\s*[\"']([^\"']*)[\"']"
CAPTCHA_WINDOW = 8_000
STATUS_IDS = ("item_status_message", "item_status_short_description_message")
ACTIVE, PAUSED, FINISHED, UNAVAILABLE = "activo", "pausado", "finalizado", "no_disponible"
OK, ERROR, NOT_FOUND, CAPTCHA = "ok", "error", "no_encontrado", "captcha"
POI_RADIUS_M = 500.0
POI_KINDS = {
    "paraderos": "paraderos",
    "estaciones de metro": "estaciones_metro",
    "jardines infantiles": "jardines_infantiles",
    "colegios": "colegios",
    "universidades": "universidades",
    "plazas": "plazas",
    "supermercados": "supermercados",
    "farmacias": "farmacias",
    "centros comerciales": "centros_comerciales",
    "hospitales": "hospitales",
    "clinicas": "clinicas",
}

CATEGORIES_TYPE = (
    "array<struct<subcategories:array<struct<title:struct<text:string>,"
    "items:array<struct<subtitle:struct<label:struct<text:string>>>>>>>>"
)


# ---------------------------------------------------------------- visible text

#: Named entities of HTML for ASCII and Latin-1, from the standard's own table.
_NAMED = {name: chr(code) for name, code in name2codepoint.items() if code < 256} | {"apos": "'"}


def decode_entities(text: Column) -> Column:
    """Named and numeric entities below U+0100 as the characters they stand for; others stay as they are.

    One pass over the pieces behind each ``&``, so ``&amp;lt;`` becomes ``&lt;``.  ``text`` and the name in each
    piece are mentioned once, since inside array functions an expression is worked out anew at each mention.
    """
    names, chars = (F.array(*[F.lit(x) for x in column]) for column in zip(*sorted(_NAMED.items())))

    def named(p: Column) -> Column:
        return F.struct(p.alias("p"), F.regexp_extract(p, r"^(#?[0-9A-Za-z]{1,8});", 1).alias("name"))

    def piece(found: Column) -> Column:
        p, name = found["p"], found["name"]
        hexadecimal = F.conv(F.regexp_extract(name, r"^#[xX]([0-9A-Fa-f]{1,4})$", 1), 16, 10).try_cast("int")
        code = F.coalesce(hexadecimal, F.regexp_extract(name, r"^#([0-9]{1,5})$", 1).try_cast("int"))
        known = F.get(chars, (F.array_position(names, name) - 1).cast("int"))
        char = F.when(name.startswith("#"), F.when((code > 0) & (code < 256), F.char(code))).otherwise(known)
        return F.coalesce(F.concat(char, F.substr(p, F.length(name) + 2)), F.concat(F.lit("&"), p))

    pieces = F.transform(F.split(text, "&"), named)
    return F.array_join(F.transform(pieces, lambda found, i: F.when(i == 0, found["p"]).otherwise(piece(found))), "")


def visible_text(html: Column) -> Column:
    """Text of the body: scripts, styles and comments removed, one line per piece of text."""
    body = F.when(html.rlike(r"(?i)<body"), F.regexp_extract(html, r"(?is)<body[^>]*>(.*)", 1)).otherwise(html)
    body = F.regexp_replace(body, r"(?is)<!--.*?-->|<(script|style|template)\b.*?</\1\s*>", "\n")
    text = decode_entities(F.regexp_replace(body, r"<[^>]*>", "\n"))
    # the patterns' \\s does not match a no-break space
    text = F.translate(text, "\u00a0", " ")
    return F.trim(F.regexp_replace(text, r"\s*\n\s*", "\n"), F.lit(" \n\t"))


# ---------------------------------------------------------------- identity and outcome

def page_matches_id(html: Column, listing: Column) -> Column:
    """The id occurs in the canonical link and in the og:url of the page."""
    canonical = F.regexp_extract(F.regexp_extract(html, CANONICAL_TAG, 0), HREF, 1)
    og_url = F.regexp_extract(F.regexp_extract(html, OG_URL_TAG, 0), CONTENT, 1)
    return F.coalesce(canonical.contains(listing) & og_url.contains(listing), F.lit(False))


def mentions_captcha(html: Column) -> Column:
    """``captcha`` among the first characters of the page."""
    return F.coalesce(F.lower(F.substring(html, 1, CAPTCHA_WINDOW)).contains("captcha"), F.lit(False))


def page_outcome(html: Column, listing: Column, text: Column | None = None) -> Column:
    """``captcha``, ``no_encontrado`` or ``ok``.

    With the page's visible ``text`` a captcha only counts when the page shows no surface and no
    bedrooms, since a background captcha script is common; without it the mention alone counts.
    """
    captcha = mentions_captcha(html)
    if text is not None:
        shows_listing = F.lit(False)
        for field in ("superficie_total_m2", "superficie_util_m2", "dormitorios"):
            shows_listing = shows_listing | text.rlike(DETAIL_PATTERNS[field])
        # a condition of its own: the text is worked out for pages with the mention alone
        captcha = F.coalesce(F.when(captcha, ~F.coalesce(shows_listing, F.lit(False))), F.lit(False))
    return (
        F.when(captcha, F.lit(CAPTCHA)).when(~page_matches_id(html, listing), F.lit(NOT_FOUND)).otherwise(F.lit(OK))
    )


# ---------------------------------------------------------------- state document

def state_document(html: Column) -> Column:
    """JSON text of the page state, NULL when the page has none."""
    return F.nullif(F.regexp_extract(html, STATE_PATTERN, 1), F.lit(""))  # a document has its braces at least


STATE_PARTS = T.StructType(
    [
        T.StructField("categories", T.StringType()),
        T.StructField("neighborhood", T.StringType()),
        T.StructField("has_status", T.BooleanType()),
        T.StructField("status_text", T.StringType()),
    ]
)


def _walk(node):
    """Every JSON object below ``node``, parents first, in document order."""
    stack = [node]
    while stack:
        here = stack.pop()
        if isinstance(here, dict):
            yield here
            stack.extend(reversed(list(here.values())))
        elif isinstance(here, list):
            stack.extend(reversed(here))


def _path(node, *keys):
    for key in keys:
        node = node.get(key) if isinstance(node, dict) else None
    return node


def _parts(document: str | None) -> tuple:
    try:
        state = json.loads(document) if document else None
    except (ValueError, RecursionError):  # malformed, or nested too deeply
        state = None
    categories = neighborhood = status = None
    for node in _walk(state):
        found = node.get("categories")
        if categories is None and isinstance(found, list) and found and isinstance(found[0], dict) and "subcategories" in found[0]:
            categories = found
        if not neighborhood:
            neighborhood = node.get("neighborhood")
    components = _path(state, "appProps", "pageProps", "initialState", "components")
    for name in ("head", "short_description"):
        if status is None:
            status = next((n for n in _walk(_path(components, name)) if n.get("id") in STATUS_IDS), None)
    text = _path(status, "body", "text")
    return (
        json.dumps(categories, ensure_ascii=False) if categories else None,
        str(neighborhood) if neighborhood else None,
        status is not None,
        text if isinstance(text, str) else None,
    )


@F.pandas_udf(STATE_PARTS)
def state_parts(documents: pd.Series) -> pd.DataFrame:
    """Parts found at any depth of the state document.

    Depth-first search at unbounded depth has no built-in counterpart, so this one step runs in
    Python, a batch of documents at a time; everything after it stays in the JVM.
    """
    return pd.DataFrame([_parts(d) for d in documents], columns=STATE_PARTS.names)


def publication_state(has_status: Column, status_text: Column) -> Column:
    """State of the listing: active without a status message, else what the message says."""
    text = F.lower(F.coalesce(status_text, F.lit("")))
    return (
        F.when(~F.coalesce(has_status, F.lit(False)), F.lit(ACTIVE))
        .when(text.contains("pausad"), F.lit(PAUSED))
        .when(text.contains("finaliz"), F.lit(FINISHED))
        .otherwise(F.lit(PAUSED))
    )


def poi_groups(categories: Column, radius_m: float = POI_RADIUS_M) -> Column:
    """Array of ``kind title, distances within the radius`` from the categories document."""
    groups = F.flatten(F.transform(F.from_json(categories, CATEGORIES_TYPE), lambda c: c["subcategories"]))
    none = F.array().cast("array<struct<subtitle:struct<label:struct<text:string>>>>")

    def near(group: Column) -> Column:
        distances = F.transform(
            F.coalesce(group["items"], none), lambda i: parse_distance_m(i["subtitle"]["label"]["text"])
        )
        return F.filter(distances, lambda d: d <= radius_m)

    return F.transform(groups, lambda g: F.struct(fold_accents(g["title"]["text"]).alias("title"), near(g).alias("near")))


def with_poi_summary(df: DataFrame, categories: str, radius_m: float = POI_RADIUS_M) -> DataFrame:
    """Per kind of place: how many lie within ``radius_m`` and the nearest of those.

    A kind that is listed without places nearby counts 0; a kind that is not listed is NULL.  When a
    kind is listed twice the later list counts.  The document is read once, not once per column.
    """
    df = df.withColumn("__groups", poi_groups(F.col(categories), radius_m))

    def listed(title: str) -> Column:
        return F.try_element_at(F.filter("__groups", lambda g: g["title"] == title), F.lit(-1))["near"]

    df = df.withColumn("__near", F.struct(*[listed(title).alias(kind) for title, kind in POI_KINDS.items()]))
    columns: dict[str, Column] = {}
    for kind in POI_KINDS.values():
        near = F.col(f"__near.{kind}")
        columns[f"cantidad_{kind}"] = F.when(near.isNotNull(), F.size(near))
        columns[f"distancia_min_m_{kind}"] = F.array_min(near)
    return df.withColumns(columns).drop("__groups", "__near")
