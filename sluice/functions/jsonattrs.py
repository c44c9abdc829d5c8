"""Content-management records as flat attributes: media, relations, links and cleaned scalars out of nested JSON.

The shape of a record depends on the record, so its JSON is walked in Python, in
Arrow batches, once per record; everything around that stays in the JVM.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.markup import links_of
from sluice.functions.text import WHITE_POINTS
from sluice.operators.nested import read_json, sound

# Names of fields.
SYSTEM_SUFFIXES = ("_id", "locale", "createdAt", "updatedAt", "publishedAt")
MEDIA = {"feature_image", "featureImage", "heroMedia", "widgetPicture", "cover_image", "photo", "business_logo", "map_image"}
MEDIA_KEYS = ["url", "alternativeText", "caption", "width", "height"]
RELATION_KEYS = ["title", "name", "fullname", "slug", "country", "countryCode"]
SEO_KEYS = ["metaTitle", "metaDescription", "canonicalURL"]
LINK_HTML = [
    "references", "description", "content", "summary", "history", "biography", "introduction", "AthleteDescription", "fullDescription",
    "career", "awardsAndRecognition", "achievements", "disciplines", "membership",
]
LINK_URLS = ["website", "facebook_url", "twitter_url", "instagram_url", "linkedin_url", "youtube_channel_url"]
# Fields whose objects and lists are kept as they are.
KEPT_WHOLE = set(
    """title slug description content summary introduction business_tagline place_tagline headline header_description biography vision mission
    history general_information city_name government_type mayor_name timezone headquarters established occupation known_for residence
    dean_name address establishment_year type population_total AthleteDescription fullDescription career awardsAndRecognition
    achievements widgetFullName widgetNickname firstname lastname fullname tagline birthdate placeOfBirth positions currentTeam
    widgetHomeStadium founded owner ownership award location capacity size keyType competitions focus disciplines membership president
    country countryCode phone email website facebook_url twitter_url instagram_url linkedin_url youtube_channel_url
    youtube_video_url""".split()
)

_SPACE = re.compile("[" + "".join(map(chr, WHITE_POINTS)) + "]+")
_TAG = re.compile("<.*?>")


def cleaned(text: str) -> str:
    return _SPACE.sub(" ", _TAG.sub("", text)).strip()


def media(value: Any) -> dict:
    """What is set of a media object's address, texts and sizes; {} for anything without one."""
    inner = value.get("data") if isinstance(value, dict) else None
    own = inner.get("attributes", {}) if isinstance(inner, dict) else None
    if not isinstance(own, dict):
        return {}
    found = {k: own[k] for k in MEDIA_KEYS if own.get(k)}
    if "caption" in found:
        if not isinstance(found["caption"], str):
            return {}
        found["caption"] = cleaned(found["caption"])
    return found


def relations(value: Any) -> list[dict]:
    """Of each related object the naming fields it has, nulls included; objects without any are left out."""
    inner = value.get("data") if isinstance(value, dict) else None
    found = []
    for item in inner if isinstance(inner, list) else [inner]:
        own = item.get("attributes") if isinstance(item, dict) else None
        if isinstance(own, dict) and (named := {k: own[k] for k in RELATION_KEYS if k in own}):
            found.append(named)
    return found


def seo(value: Any) -> dict:
    """Cleaned title and description and the canonical URL, as far as set."""
    if not isinstance(value, dict):
        return {}
    found = {k: value[k] for k in SEO_KEYS if value.get(k)}
    if any(not isinstance(found.get(k, ""), str) for k in SEO_KEYS[:2]):
        return {}
    return {k: v if k == "canonicalURL" else cleaned(v) for k, v in found.items()}


def _display(field: str) -> str:
    return field.replace("_", " ").replace("url", "").strip().title()


def links(attributes: dict) -> list[dict]:
    """Links of the HTML fields, in the order of the field list, then the URL fields; the first of equal URLs stays."""
    found: dict[str, str] = {}
    for field in LINK_HTML:
        if attributes.get(field):
            for text, url in links_of(str(attributes[field])):
                found.setdefault(url, text)
    for field in LINK_URLS:
        if attributes.get(field) and (url := str(attributes[field]).strip()):
            found.setdefault(url, _display(field))
    return [{"text": text, "url": url} for url, text in found.items()]


def flat_attributes(attributes: dict) -> dict:
    """The attributes to keep: media, relations and SEO reduced, strings cleaned, system fields, empty values and other
    objects and lists left out; `sources` are the record's links."""
    out: dict[str, Any] = {}
    for key, value in attributes.items():
        if key.endswith(SYSTEM_SUFFIXES):
            continue
        if key in MEDIA:
            kept: Any = media(value) or None
        elif key == "seo":
            kept = seo(value) or None
        elif isinstance(value, dict) and "data" in value:
            kept = relations(value) or None
        elif isinstance(value, str):
            kept = cleaned(value) or None
        elif isinstance(value, (dict, list)) and value and key not in KEPT_WHOLE:
            kept = None
        else:
            kept = value
        if kept is not None:
            out[key] = kept
    if found := links(attributes):
        out["sources"] = found
    return out


def application_source(attributes: dict, fixed: str | None = None) -> str:
    """A record's source by the applications it is for: `fixed` if given, the one id, a list of ids, or `0`."""
    if fixed is not None:
        return fixed
    holder = attributes.get("applications", {})
    inner = holder.get("data", []) if isinstance(holder, dict) else None
    if not isinstance(inner, list):
        return "0"
    ids = [str(app["id"]) for app in inner if isinstance(app, dict) and app.get("id")]
    if len(ids) < 2:
        return ids[0] if ids else "0"
    try:
        return json.dumps([int(x) for x in ids])
    except ValueError:
        return "0"



def structured(records: DataFrame, attributes: str = "attributes", fixed_source: str | None = None) -> DataFrame:
    """Adds to each record: app_source, clean_title, clean_slug, clean_locale, flat_json, n_sources, problem.

    `problem` says why a record can't be structured (null, invalid or no-object JSON, a title that is no
    text); its other new columns are then null.  Missing slug is '', missing locale `en`; explicit nulls stay.
    """
    columns = records.columns

    def one(text: str | None) -> tuple:
        try:
            own = read_json(text)
        except ValueError:
            return (None,) * 6 + ("attributes are no JSON",)
        if not isinstance(own, dict):
            return (None,) * 6 + ("attributes are no object",)
        title = own.get("title") or ""
        if not isinstance(title, str):
            return (None,) * 6 + ("title is no text",)
        as_text = lambda v: v if v is None else sound(v) if isinstance(v, str) else json.dumps(v)
        flat = flat_attributes(own)
        return application_source(own, fixed_source), sound(cleaned(title)), as_text(own.get("slug", "")), as_text(own.get("locale", "en")), sound(json.dumps(flat, ensure_ascii=False)), len(links(own)), None

    names = ["app_source", "clean_title", "clean_slug", "clean_locale", "flat_json", "n_sources", "problem"]
    kinds = [pa.string()] * 5 + [pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [one(t) for t in batch.column(batch.schema.get_field_index(attributes)).to_pylist()]
            new = [pa.array([g[k] for g in got], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*columns, *names])

    if clash := set(names) & set(columns):
        raise ValueError(f"columns named like results: {sorted(clash)}")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema) + ", " + ", ".join(f"{n} {'int' if n == 'n_sources' else 'string'}" for n in names)
    return records.mapInArrow(run, schema)


def kept_keys(keys: Column) -> Column:
    """The keys that are no system fields, in the JVM."""
    return F.filter(keys, lambda k: ~k.rlike("(" + "|".join(SYSTEM_SUFFIXES) + ")$"))
