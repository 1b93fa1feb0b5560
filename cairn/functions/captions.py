"""Inputs, prompts and replies of caption models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, strip_disclaimers

#: The prompts' wording.
RECORD_ORDER = """Write a short and neutral description in English (1-2 sentences) about an archaeological site.
Use simple, factual language that is accessible to visitors.
Focus on the most relevant and interesting details, such as the type of site, approximate age, location, and any unique features.
Avoid emotional, dramatic, or promotional language.
Do not include any headers, introductions, URLs, or extra commentary. Return only the description.
"""
TEXT_ORDER = """
Write a concise description in English (1–3 sentences) for visitors.
Use the details under "Description (sv)" first (type, size, shape, structure, features, vegetation).
Add terrain/orientation only if space allows.
Do NOT include any headers like 'Site description:' or repeat the classification.
Do NOT mention reference numbers, status, verification, or data quality.
Return ONLY the description text.

Input:
"""
RECORD_FIELDS = ("class", "description", "vegetation", "tradition", "damage_status", "location")


def _given(label: str, c: Column) -> Column:
    c = strip(F.coalesce(c, F.lit("")))
    return F.when(c != "", F.concat(F.lit(label), c))


def caption_input(class_sv: Column, class_en: Column, description: Column, terrain: Column, orientation: Column) -> Column:
    """Class, description and optional lines; '' when no description is left without its disclaimers."""
    name = strip(F.coalesce(class_sv, F.lit("")))
    named = F.when(name == "", None).when(class_en.isNotNull(), F.concat(name, F.lit(" ("), class_en, F.lit(")"))).otherwise(name)
    body = strip_disclaimers(F.coalesce(description, F.lit("")))
    lines = F.concat_ws("\n", named, F.concat(F.lit("Description (sv): "), body), _given("Terrain (sv): ", terrain), _given("Orientation (sv): ", orientation))
    return F.when(body == "", F.lit("")).otherwise(lines)


def record_prompt(fields: dict[str, Column], order: str = RECORD_ORDER) -> Column:
    """Six lines of a record, a null printed as null, then the order."""
    data = F.concat(*[x for n in RECORD_FIELDS for x in (F.lit(f"{n}: "), F.coalesce(fields[n], F.lit("null")), F.lit(",\n"))])
    return F.concat(F.lit("\n    SOURCE DATA:\n    "), data, F.lit("\n\n    YOUR INSTRUCTIONS:\n    "), F.lit(order), F.lit("\n    "))


def text_prompt(given: Column) -> Column:
    """The order with the input in it, and the input again."""
    return F.concat(F.lit(TEXT_ORDER), given, F.lit("\n"), F.lit("\n\nSite description: "), given)


def or_empty(description: Column, caption: Column) -> Column:
    """The caption, or a fixed mark where there is no description to make one from."""
    return F.when(F.coalesce(description, F.lit("")) == "", F.lit("empty description")).otherwise(caption)


def clean_caption(reply: Column) -> Column:
    """Without the rest of the line behind the first empty line, one leading line end, and the first heading's line."""
    line = r"[^\n\r\x{2028}\x{2029}]*"
    c = F.regexp_replace(reply, rf"(?s)\A(.*?)\n\n{line}", "$1")
    c = F.regexp_replace(c, r"\A\n", "")
    return F.regexp_replace(c, rf"(?s)\A(.*?)\n#{line}", "$1")


def flat_caption(reply: Column) -> Column:
    return F.replace(strip(reply), F.lit("\n"), F.lit(" "))
