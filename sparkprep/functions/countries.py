"""Alias dimension for country names: overrides first, then ISO 3166."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkprep.functions.columns import small_frame
from sparkprep.functions.text import normal_text
from sparkprep.presets import (
    COUNTRY_OVERRIDES,
    ISO_SHORT_NAMES,
    OFFICIAL_NAMES,
)


def country_aliases(spark: SparkSession, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Alias -> canonical country name, keys in normal form.

    Letter codes and English names come from the locale data of the JVM, numeric codes from the region data that
    Spark brings along, official names from the presets. ``extra`` adds or replaces aliases. Names may change
    with the JVM: :func:`country_table` makes a table that can be kept and passed to every run. A resolved name that is itself an override key takes the
    override, so every alias of a country ends in one name.
    """
    overrides = {normal_text(k): v for k, v in COUNTRY_OVERRIDES.items()}
    standard = {v.lower(): v for v in COUNTRY_OVERRIDES.values()}
    locale = spark._jvm.java.util.Locale
    aliases: dict[str, str] = {}
    official: dict[str, str] = {}
    for code in locale.getISOCountries():
        place = locale("", code)
        common = place.getDisplayCountry(locale.ENGLISH)
        name = ISO_SHORT_NAMES.get(code, common)
        name = overrides.get(normal_text(name), standard.get(name.lower(), name))
        for alias in (code, place.getISO3Country(), common, name):
            aliases.setdefault(normal_text(alias), name)
        official[code] = name
    for alias, code in OFFICIAL_NAMES.items():
        aliases.setdefault(normal_text(alias), official[code])
    region = spark._jvm.com.ibm.icu.util.Region
    for code, name in official.items():
        number = region.getInstance(code).getNumericCode()
        if number > 0:
            aliases.setdefault(str(number), name)
            aliases.setdefault(f"{number:03d}", name)
    aliases.update(overrides)
    aliases.update({normal_text(k): v for k, v in (extra or {}).items()})
    return aliases


def country_table(spark: SparkSession, extra: dict[str, str] | None = None) -> DataFrame:
    """(alias, name) of :func:`country_aliases`, to be written once and read by later runs."""
    return small_frame(spark, sorted(country_aliases(spark, extra).items()), "alias string, name string")
