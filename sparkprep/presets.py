"""Column roles and rules for a table of food products with a five-class label.

Fixed values: they name the columns of the public product table and the rules its
preparation uses. Every operator takes them as parameters, so any table can be prepared.
"""

LABEL = "nutriscore_grade"
SPLIT = "split_group"
VALID_LABELS = ["a", "b", "c", "d", "e"]

# Columns kept from the raw dump when present.
RAW_COLUMNS = [
    "nutriscore_grade",
    "code",
    "product_name",
    "brands",
    "categories",
    "countries",
    "energy_100g",
    "energy-kcal_100g",
    "fat_100g",
    "saturated-fat_100g",
    "carbohydrates_100g",
    "sugars_100g",
    "fiber_100g",
    "proteins_100g",
    "salt_100g",
    "sodium_100g",
    "fruits-vegetables-nuts_100g",
    "fruits-vegetables-nuts-estimate_100g",
    "additives_n",
    "ingredients_n",
    "nutrition_grade_fr",
    "pnns_groups_1",
    "pnns_groups_2",
    "main_category",
]
NUMERIC_COLUMNS = [c for c in RAW_COLUMNS if c.endswith("_100g")] + [
    "additives_n",
    "ingredients_n",
]

# Never scaled, never reduced, carried along.
METADATA = ["nutriscore_grade", "split_group", "product_name", "brands", "code"]
PRESERVED = ["product_name", "brands", "code"]

MULTI_LABEL = ["countries"]
ONE_HOT = ["pnns_groups_1"]
TARGET_ENCODED = ["pnns_groups_2"]
ZERO_FILLED = ["additives_n"]
REDUNDANT = ["energy_100g"]
WIDE_TEXT = ["main_category", "categories"]

# Inclusive valid ranges per 100 g, in rule order.
VALID_RANGES = {
    "fat_100g": (0.0, 100.0),
    "saturated-fat_100g": (0.0, 100.0),
    "carbohydrates_100g": (0.0, 100.0),
    "sugars_100g": (0.0, 100.0),
    "fiber_100g": (0.0, 100.0),
    "proteins_100g": (0.0, 100.0),
    "salt_100g": (0.0, 50.0),
}

# Derived columns: (new column, numerator, denominator), (new column, source, factor),
# (new column, source, strict threshold).
RATIOS = [
    ("fat_to_protein_ratio", "fat_100g", "proteins_100g"),
    ("sugar_to_carb_ratio", "sugars_100g", "carbohydrates_100g"),
    ("saturated_to_total_fat_ratio", "saturated-fat_100g", "fat_100g"),
]
ENERGY_DENSITY = [("energy_density", "energy-kcal_100g", 100.0)]
CALORIES = [
    ("calories_from_fat", "fat_100g", 9.0),
    ("calories_from_carbs", "carbohydrates_100g", 4.0),
    ("calories_from_protein", "proteins_100g", 4.0),
]
FLAGS = [
    ("high_fat", "fat_100g", 20.0),
    ("high_sugar", "sugars_100g", 15.0),
    ("high_salt", "salt_100g", 1.5),
]

# Texts that the delimited source means as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Country aliases that win over the ISO 3166 lookup.
COUNTRY_OVERRIDES = {
    "plurinational state of": "Bolivia",
    "bolivarian republic of": "Venezuela",
    "republic of korea": "South Korea",
    "usa": "United States",
    "us": "United States",
    "en:us": "United States",
    "états-unis": "United States",
    "uk": "United Kingdom",
    "en:gb": "United Kingdom",
    "royaume-uni": "United Kingdom",
    "de": "Germany",
    "deutschland": "Germany",
    "Deutschland": "Germany",
    "allemagne": "Germany",
    "fr": "France",
    "en:fr": "France",
    "francia": "France",
    "es": "Spain",
    "españa": "Spain",
    "espagne": "Spain",
    "it": "Italy",
    "italia": "Italy",
    "nl": "Netherlands",
    "nederland": "Netherlands",
    "holland": "Netherlands",
    "be": "Belgium",
    "belgique": "Belgium",
    "ch": "Switzerland",
    "suisse": "Switzerland",
    "schweiz": "Switzerland",
    "cz": "Czechia",
    "česko": "Czechia",
    "pl": "Poland",
    "polska": "Poland",
    "se": "Sweden",
    "sverige": "Sweden",
    "no": "Norway",
    "norge": "Norway",
    "ru": "Russian Federation",
    "russia": "Russian Federation",
    "jp": "Japan",
    "cn": "China",
    "br": "Brazil",
    "brasil": "Brazil",
}

# ISO 3166 short names (without commas) where the locale data of the JVM names the
# country differently; keyed by alpha-2 code.
ISO_SHORT_NAMES = {
    "AG": "Antigua and Barbuda",
    "BA": "Bosnia and Herzegovina",
    "BL": "Saint Barthélemy",
    "BN": "Brunei Darussalam",
    "CG": "Congo",
    "CI": "Côte d'Ivoire",
    "CV": "Cabo Verde",
    "GS": "South Georgia and the South Sandwich Islands",
    "HK": "Hong Kong",
    "HM": "Heard Island and McDonald Islands",
    "KN": "Saint Kitts and Nevis",
    "LA": "Lao People's Democratic Republic",
    "LC": "Saint Lucia",
    "MM": "Myanmar",
    "MO": "Macao",
    "PM": "Saint Pierre and Miquelon",
    "PN": "Pitcairn",
    "RU": "Russian Federation",
    "SJ": "Svalbard and Jan Mayen",
    "ST": "Sao Tome and Principe",
    "SY": "Syrian Arab Republic",
    "TC": "Turks and Caicos Islands",
    "TR": "Türkiye",
    "TT": "Trinidad and Tobago",
    "UM": "United States Minor Outlying Islands",
    "VA": "Holy See (Vatican City State)",
    "VC": "Saint Vincent and the Grenadines",
    "VN": "Viet Nam",
    "WF": "Wallis and Futuna",
}

# Official names whose form no rule gives, by ISO code.
OFFICIAL_NAMES = {
    "Arab Republic of Egypt": "EG",
    "Argentine Republic": "AR",
    "Bolivarian Republic of Venezuela": "VE",
    "Commonwealth of the Bahamas": "BS",
    "Czech Republic": "CZ",
    "French Republic": "FR",
    "Gabonese Republic": "GA",
    "Hashemite Kingdom of Jordan": "JO",
    "Hellenic Republic": "GR",
    "Italian Republic": "IT",
    "Kyrgyz Republic": "KG",
    "Lao People's Democratic Republic": "LA",
    "Lebanese Republic": "LB",
    "Plurinational State of Bolivia": "BO",
    "Portuguese Republic": "PT",
    "Republic of Korea": "KR",
    "Russian Federation": "RU",
    "Slovak Republic": "SK",
    "Socialist Republic of Viet Nam": "VN",
    "Swiss Confederation": "CH",
    "Syrian Arab Republic": "SY",
    "Togolese Republic": "TG",
    "United Kingdom of Great Britain and Northern Ireland": "GB",
    "United Mexican States": "MX",
    "United States of America": "US",
}

# The forms of state that official names put before the country's name.
OFFICIAL_FORMS = [
    "Commonwealth of",
    "Democratic Republic of",
    "Federal Democratic Republic of",
    "Federal Republic of",
    "Federative Republic of",
    "Grand Duchy of",
    "Islamic Republic of",
    "Kingdom of",
    "Kingdom of the",
    "People's Democratic Republic of",
    "People's Republic of",
    "Principality of",
    "Republic of",
    "Republic of the",
    "Socialist Republic of",
    "State of",
    "Sultanate of",
    "Union of",
    "United Republic of",
]
