"""The data model: record schemas, output columns and the code books.

A ``CodeBook`` holds everything that differs between inputs of the same
shape: total codes, the age-band limit, English labels per code. The
builds take a code book, so the same code runs on the published data
(``REFERENCE_BOOK``) and on the stand-in built from the test tables
(``plans.bindings.STANDIN_BOOK``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (field names, total codes,
# band limit, label rewrites, English labels, section ranges, happiness
# headers and country renames). Kept together, in the reference's order.
# ---------------------------------------------------------------------------
RAW_FIELDS = ["ID", "Geslacht", "LeeftijdOp31December", "BurgerlijkeStaat",
              "Geboorteland", "Perioden", "Immigratie_1"]
REFERENCE_TOTALS = {"Geslacht": "T001038", "LeeftijdOp31December": "10000",
                    "BurgerlijkeStaat": "T001019", "Geboorteland": "T001175"}
REFERENCE_AGE_BAND_LIMIT = 19906
AGE_LABEL_CHAIN = [("Totaal", "Total"), ("jaar", ""), "strip", ("of ouder", "or older"), ("tot", "to")]
REFERENCE_GENDER_EN = {"T001038": "Total men and women", "3000": "Men", "4000": "Women"}
REFERENCE_MARITAL_EN = {"T001019": "Total", "1010": "Unmarried", "1020": "Married",
                        "1050": "Remarried", "1080": "Divorced"}
# (skiprows, nrows) of gender, age, marital status, birth country, period
REFERENCE_SECTION_RANGES = [(17, 3), (22, 128), (152, 5), (159, 263), (424, 26)]
HAPPINESS_COLS = ["Country", "Happiness_Score", "GDP_Score", "Health_Score", "Freedom_Score",
                  "Generosity_Score", "Corruption_Score", "Year"]
HAPPINESS_LAYOUT_2018 = {"Country or region": "Country", "Score": "Happiness_Score",
                         "GDP per capita": "GDP_Score", "Healthy life expectancy": "Health_Score",
                         "Freedom to make life choices": "Freedom_Score",
                         "Generosity": "Generosity_Score",
                         "Perceptions of corruption": "Corruption_Score"}
HAPPINESS_LAYOUT_2020 = {"Country name": "Country", "Ladder score": "Happiness_Score",
                         "Explained by: Log GDP per capita": "GDP_Score",
                         "Explained by: Healthy life expectancy": "Health_Score",
                         "Explained by: Freedom to make life choices": "Freedom_Score",
                         "Explained by: Generosity": "Generosity_Score",
                         "Explained by: Perceptions of corruption": "Corruption_Score"}
COUNTRY_RENAMES = {"Congo (Brazzaville)": "Congo", "Congo (Kinshasa)": "Congo",
                   "Taiwan Province of China": "Taiwan", "Trinidad & Tobago": "Trinidad and Tobago",
                   "Northern Cyprus": "Cyprus", "North Cyprus": "Cyprus",
                   "North Macedonia": "Macedonia"}
# ---------------------------------------------------------------------------

FACT_COLS = ["ID", "Gender", "Age", "MaritalStatus", "Country", "ImmigrationVolume",
             "SingleCountry", "Year"]
CODE_COLS = ["Geslacht", "LeeftijdOp31December", "BurgerlijkeStaat", "Geboorteland", "Perioden"]
SECTION_NAMES = ["gender", "age", "marital", "country", "period"]

# The fact table's contract (types as documented for the output).
FACT_CONTRACT = StructType([
    StructField("ID", StringType()),
    StructField("Gender", StringType()),
    StructField("Age", IntegerType()),
    StructField("MaritalStatus", StringType()),
    StructField("Country", StringType()),
    StructField("ImmigrationVolume", IntegerType()),
    StructField("SingleCountry", StringType()),
    StructField("Year", IntegerType()),
])

RAW_SCHEMA = StructType([
    StructField("ID", StringType()),
    StructField("Geslacht", StringType()),
    StructField("LeeftijdOp31December", StringType()),
    StructField("BurgerlijkeStaat", StringType()),
    StructField("Geboorteland", StringType()),
    StructField("Perioden", StringType()),
    StructField("Immigratie_1", IntegerType()),
])

# Needed columns of the yearly happiness files by layout, read by name; the
# files hold further ones (rank, region, errors), which are ignored.
LAYOUT_2018_COLUMNS = ["Overall rank", "Country or region", "Score", "GDP per capita",
                       "Social support", "Healthy life expectancy",
                       "Freedom to make life choices", "Generosity",
                       "Perceptions of corruption"]
LAYOUT_2020_COLUMNS = ["Country name", "Regional indicator", "Ladder score",
                       "Standard error of ladder score",
                       "Explained by: Log GDP per capita", "Explained by: Social support",
                       "Explained by: Healthy life expectancy",
                       "Explained by: Freedom to make life choices",
                       "Explained by: Generosity",
                       "Explained by: Perceptions of corruption", "Dystopia + residual"]


def needed_columns(mapping: dict[str, str]) -> StructType:
    """The source columns of a layout, typed."""
    return StructType([StructField(c, StringType() if to == "Country" else DoubleType())
                       for c, to in mapping.items()])


HAPPINESS_LAYOUTS = {
    "2018": (needed_columns(HAPPINESS_LAYOUT_2018), HAPPINESS_LAYOUT_2018),
    "2020": (needed_columns(HAPPINESS_LAYOUT_2020), HAPPINESS_LAYOUT_2020),
}


def reference_layout(year: int) -> str:
    """The reference picks the header layout by year: 2020 has the new one."""
    return "2020" if year >= 2020 else "2018"


@dataclass(frozen=True)
class CodeBook:
    totals: dict[str, str]
    age_band_limit: int
    gender_en: dict[str, str]
    marital_en: dict[str, str]
    dedup_key: tuple[str, ...] = ("ID",)
    extra: dict = field(default_factory=dict)


REFERENCE_BOOK = CodeBook(REFERENCE_TOTALS, REFERENCE_AGE_BAND_LIMIT,
                          REFERENCE_GENDER_EN, REFERENCE_MARITAL_EN)
