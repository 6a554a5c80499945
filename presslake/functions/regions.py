"""Region and language lookups as literal maps: they are constants, so no join is needed."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Region -> languages to query, most useful first.
REGION_LANGUAGES = {
    "andhra-pradesh": ["te", "en"],
    "arunachal-pradesh": ["en", "hi"],
    "assam": ["as", "en", "bn", "hi"],
    "bihar": ["hi", "en", "ur"],
    "chhattisgarh": ["hi", "en"],
    "goa": ["en", "mr", "kn"],
    "gujarat": ["gu", "en", "hi"],
    "haryana": ["hi", "en", "pa"],
    "himachal-pradesh": ["hi", "en"],
    "jharkhand": ["hi", "en"],
    "karnataka": ["kn", "en", "te", "ta"],
    "kerala": ["ml", "en", "ta"],
    "madhya-pradesh": ["hi", "en"],
    "maharashtra": ["mr", "en", "hi"],
    "manipur": ["mni", "en", "hi"],
    "meghalaya": ["en", "hi"],
    "mizoram": ["lus", "en", "hi"],
    "nagaland": ["en", "hi"],
    "odisha": ["or", "en", "hi"],
    "punjab": ["pa", "en", "hi"],
    "rajasthan": ["hi", "en"],
    "sikkim": ["ne", "en", "hi"],
    "tamil-nadu": ["ta", "en"],
    "telangana": ["te", "en", "ur"],
    "tripura": ["bn", "en", "hi"],
    "uttar-pradesh": ["hi", "en", "ur"],
    "uttarakhand": ["hi", "en"],
    "west-bengal": ["bn", "en", "hi"],
    "andaman-and-nicobar-islands": ["en", "hi", "bn", "ta"],
    "chandigarh": ["hi", "en", "pa"],
    "dadra-and-nagar-haveli-and-daman-and-diu": ["gu", "en", "hi", "mr"],
    "lakshadweep": ["en", "ml"],
    "delhi": ["hi", "en", "ur", "pa"],
    "puducherry": ["ta", "en", "ml", "te"],
    "jammu-and-kashmir": ["en", "hi", "ur"],
    "ladakh": ["en", "hi", "ur"],
}

# Region -> primary language.
PRIMARY_LANGUAGE = {
    "andhra-pradesh": "te",
    "arunachal-pradesh": "en",
    "assam": "as",
    "bihar": "hi",
    "chhattisgarh": "hi",
    "goa": "en",
    "gujarat": "gu",
    "haryana": "hi",
    "himachal-pradesh": "hi",
    "jharkhand": "hi",
    "karnataka": "kn",
    "kerala": "ml",
    "madhya-pradesh": "hi",
    "maharashtra": "mr",
    "manipur": "mni",
    "meghalaya": "en",
    "mizoram": "lus",
    "nagaland": "en",
    "odisha": "or",
    "punjab": "pa",
    "rajasthan": "hi",
    "sikkim": "ne",
    "tamil-nadu": "ta",
    "telangana": "te",
    "tripura": "bn",
    "uttar-pradesh": "hi",
    "uttarakhand": "hi",
    "west-bengal": "bn",
    "andaman-and-nicobar-islands": "en",
    "chandigarh": "hi",
    "dadra-and-nagar-haveli-and-daman-and-diu": "gu",
    "lakshadweep": "ml",
    "delhi": "hi",
    "puducherry": "ta",
    "jammu-and-kashmir": "ur",
    "ladakh": "hi",
}

# Language code -> name.
LANGUAGE_NAMES = {
    "en": "English", "hi": "Hindi", "ta": "Tamil", "te": "Telugu", "ml": "Malayalam", "kn": "Kannada",
    "bn": "Bengali", "gu": "Gujarati", "mr": "Marathi", "or": "Odia", "pa": "Punjabi", "as": "Assamese",
    "ur": "Urdu", "ne": "Nepali", "mni": "Meitei (Manipuri)", "lus": "Mizo (Lushai)",
}

# Names a newspaper list uses for languages whose official name differs.
LANGUAGE_ALIASES = {"Mizo": "lus", "Meitei": "mni", "Manipuri": "mni"}

# English impact terms, the fallback for every language without its own list.
# The lists of the other languages are a parameter (``terms``), read with ``read_terms``.
ENGLISH_TERMS = [
    "monsoon", "heavy rain", "cloudburst", "flood", "flash flood", "waterlogging", "landslide",
    "cyclone", "power outage", "pipeline burst", "sewage overflow", "snakebite", "cholera",
    "dengue", "malaria", "economic loss", "deaths", "rainfall", "storm", "weather alert",
    "weather warning", "IMD", "meteorological", "precipitation", "downpour", "rescue operations",
    "relief camps", "evacuation", "water level", "dam overflow", "bridge collapse",
]

# Languages that get default keywords.
DEFAULT_KEYWORD_LANGUAGES = ["en", "hi", "te", "ta", "ml", "kn", "bn", "gu", "mr", "or", "pa"]


def string_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def text_map(values: dict[str, str]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])


def list_map(values: dict[str, list[str]]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), string_array(v))])


def primary_language(region: Column) -> Column:
    return F.coalesce(F.try_element_at(text_map(PRIMARY_LANGUAGE), region), F.lit("en"))


def languages_of(region: Column) -> Column:
    return F.coalesce(F.try_element_at(list_map(REGION_LANGUAGES), region), string_array(["en"]))


def language_name(code: Column) -> Column:
    return F.coalesce(F.try_element_at(text_map(LANGUAGE_NAMES), code), code)


def language_code(name: Column) -> Column:
    """Code for a language name as newspapers write it; NULL when unknown."""
    codes = {v: k for k, v in LANGUAGE_NAMES.items()} | LANGUAGE_ALIASES
    return F.try_element_at(text_map(codes), name)


def impact_terms(code: Column, terms: dict[str, list[str]] | None = None) -> Column:
    """Impact terms of a language, English when it has none. ``terms`` adds or replaces languages."""
    table = {"en": ENGLISH_TERMS} | (terms or {})
    return F.coalesce(F.try_element_at(list_map(table), code), string_array(table["en"]))


def region_slug(label: Column) -> Column:
    """``Andaman & Nicobar Islands`` -> ``andaman-and-nicobar-islands``."""
    text = F.regexp_replace(F.lower(F.trim(label)), "&", "and")
    return F.regexp_replace(text, "[^a-z0-9]+", "-")
