"""Stand-in bindings: the reference's inputs derived from the test tables.

The published immigration files are not available, so the fact's raw
records are built from ``lineitem ⋈ orders ⋈ customer ⋈ part`` (one record
per lineitem row; ``(l_orderkey, l_linenumber)`` repeats, so the dedup on ID
really removes rows):

==========================  ===============================================
reference field             stand-in
==========================  ===============================================
ID                          ``l_orderkey || '-' || l_linenumber``
Geslacht (gender code)      ``l_returnflag``; ``R`` plays the total code; NULL
                            for some parts
LeeftijdOp31December (age)  ``10000 + 10 * p_size``; sizes 46-50 are bands; for
                            some parts padded, signed, 10-digit or malformed
BurgerlijkeStaat (marital)  ``o_orderpriority`` + trailing blanks;
                            ``4-NOT SPECIFIED`` plays the total code
Geboorteland (country)      ``c_nationkey``; nation -> translation (2 hops);
                            an unknown code for some customers, and one nation
                            has no translation
Perioden                    ``year(o_orderdate) || 'JJ00'``, for some customers
                            with a trailing no-break space
Immigratie_1 (measure)      ``nullif(int(l_quantity), 50) - 1``: 0 and NULL
                            occur, as in the published data
SingleCountry               ``'Y'`` unless the nation is in region 4
==========================  ===============================================

The happiness dimension is one row per (supplier nation, ship year) with
six scores made from lineitem averages by integer arithmetic, so every
engine gets the same doubles; one (nation, year) is missing and some cells
are ``N/A``. Code lists are the distinct codes of the
tables, labelled by rule. All of it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.strings import decode_map
from tallystar.plans.model import CodeBook

# Stand-in codes (fixed values of the binding).
STANDIN_GENDER = {"A": ("Mannen", "Men"), "N": ("Vrouwen", "Women"),
                  "R": ("Totaal mannen en vrouwen", "Total men and women")}
STANDIN_MARITAL = {"1-URGENT": ("Ongehuwd", "Unmarried"), "2-HIGH": ("Gehuwd", "Married"),
                   "3-MEDIUM": ("Verweduwd", "Remarried"),
                   "4-NOT SPECIFIED": ("Totaal burgerlijke staat", "Total"),
                   "5-LOW": ("Gescheiden", "Divorced")}
STANDIN_TOTALS = {"Geslacht": "R", "LeeftijdOp31December": "10000",
                  "BurgerlijkeStaat": "4-NOT SPECIFIED", "Geboorteland": "T001175"}
STANDIN_AGE_BAND_LIMIT = 10460
STANDIN_BOOK = CodeBook(STANDIN_TOTALS, STANDIN_AGE_BAND_LIMIT,
                        {k: v[1] for k, v in STANDIN_GENDER.items()},
                        {k: v[1] for k, v in STANDIN_MARITAL.items()})
MARITAL_PAD = "   "
# Years from this one on are written with the newer happiness header layout.
STANDIN_LAYOUT_SWITCH = 2000
# Rows made to fail a rule or a join (fixed values of the binding).
UNKNOWN_COUNTRY = "99"
UNTRANSLATED_NATION = 13
UNSCORED = (9, 1997)       # nation, year
NULL_SCORE_YEAR = 1998     # Corruption_Score of nations 3, 10, 17, 24
# Records per keyed-JSON document when landing the raw records; the files of
# FILE_NAMED_YEAR have the year in their names, as the published ones do.
FILE_NAMED_YEAR = 1998
RECORDS_PER_DOC = 10_000


def standin_layout(year: int) -> str:
    return "2020" if year >= STANDIN_LAYOUT_SWITCH else "2018"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def english_name(c: str) -> Column:
    """``NATION_7`` -> ``Nation_7``: the English country name of the stand-in."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.expr(f"substr({c}, 2)")))


# ---------------------------------------------------------------- raw records
def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's seven raw fields, one row per lineitem row."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity")
    # the year alone goes through the join's shuffle, not the time
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("_year"),
                                              "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, o.o_custkey == c.c_custkey)
         .join(p, li.l_partkey == p.p_partkey))
    age = (F.lit(10000) + F.lit(10) * F.col("p_size")).cast("string")
    odd = F.col("l_partkey") % 97
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("ID"),
        F.when(F.col("l_partkey") % 89 != 3, F.col("l_returnflag")).alias("Geslacht"),
        F.when(odd == 5, F.concat(age, F.lit("abc"))).when(odd == 7, F.concat(F.lit("00000"), age))
        .when(odd == 11, F.lit("2000000000")).when(odd == 13, F.lit("-5")).when(odd == 17, F.lit("1e5"))
        .otherwise(age).alias("LeeftijdOp31December"),
        F.concat(F.col("o_orderpriority"), F.lit(MARITAL_PAD)).alias("BurgerlijkeStaat"),
        F.when(F.col("c_custkey") % 83 == 1, F.lit(UNKNOWN_COUNTRY))
        .otherwise(F.col("c_nationkey").cast("string")).alias("Geboorteland"),
        F.concat(F.col("_year").cast("string"), F.lit("JJ00"),
                 F.when(F.col("c_custkey") % 79 == 2, F.lit("\u00a0")).otherwise(F.lit(""))).alias("Perioden"),
        (F.nullif(F.col("l_quantity").cast("int"), F.lit(50)) - 1).alias("Immigratie_1"),
    )


# ----------------------------------------------------------------- code lists
def _age_title(size: Column) -> Column:
    band_lo = (size - 46) * 5
    return (F.when(size <= 44, F.concat((size - 1).cast("string"), F.lit(" jaar")))
            .when(size == 45, F.concat((size - 1).cast("string"), F.lit(" jaar of ouder")))
            .otherwise(F.concat(band_lo.cast("string"), F.lit(" tot "), (band_lo + 5).cast("string"),
                                F.lit(" jaar"))))


def code_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(section, sort_key, Key, Title)`` for the five code lists, taken from
    the distinct codes in the tables (a code domain, so small)."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    gender_nl = {k: v[0] for k, v in STANDIN_GENDER.items()}
    marital_nl = {k: v[0] for k, v in STANDIN_MARITAL.items()}
    gender = li.select(F.col("l_returnflag").alias("Key")).distinct() \
        .select(F.lit(0).alias("section"), F.col("Key").alias("sort_key"), "Key",
                decode_map("Key", gender_nl).alias("Title"))
    sizes = table(spark, sf_dir, "part").select(F.col("p_size").alias("s")).distinct()
    age_total = spark.range(1).select(F.lit(1).alias("section"), F.lit("").alias("sort_key"),
                                      F.lit("10000").alias("Key"), F.lit("Totaal leeftijd").alias("Title"))
    age = sizes.select(F.lit(1).alias("section"), F.lpad(F.col("s").cast("string"), 6, "0").alias("sort_key"),
                       (F.lit(10000) + F.lit(10) * F.col("s")).cast("string").alias("Key"),
                       _age_title(F.col("s")).alias("Title"))
    marital = orders.select(F.col("o_orderpriority").alias("k")).distinct() \
        .select(F.lit(2).alias("section"), F.col("k").alias("sort_key"),
                F.concat("k", F.lit(MARITAL_PAD)).alias("Key"), decode_map("k", marital_nl).alias("Title"))
    country = table(spark, sf_dir, "nation").select(
        F.lit(3).alias("section"), F.lpad(F.col("n_nationkey").cast("string"), 6, "0").alias("sort_key"),
        F.col("n_nationkey").cast("string").alias("Key"), F.col("n_name").alias("Title"))
    period = orders.select(F.year("o_orderdate").cast("string").alias("y")).distinct() \
        .select(F.lit(4).alias("section"), F.col("y").alias("sort_key"),
                F.concat("y", F.lit("JJ00")).alias("Key"), F.col("y").alias("Title"))
    return gender.unionByName(age_total).unionByName(age).unionByName(marital) \
        .unionByName(country).unionByName(period)


def translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land_Dutch -> Country (+ SingleCountry), from nation and region."""
    nation = table(spark, sf_dir, "nation").where(F.col("n_nationkey") != UNTRANSLATED_NATION)
    region = table(spark, sf_dir, "region")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return j.select(F.col("n_name").alias("Land_Dutch"), english_name("n_name").alias("Country"),
                    F.when(F.col("n_regionkey") < 4, "Y").otherwise("N").alias("SingleCountry"))


# ------------------------------------------------------------------ happiness
def happiness_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (Country, Year) with the six scores plus the columns only
    the files carry (Social support, region).

    lineitem is aggregated per (supplier, year) before it meets supplier, so
    the join sees one row per supplier-year instead of one per lineitem."""
    li = table(spark, sf_dir, "lineitem")
    pre = li.groupBy("l_suppkey", F.year("l_shipdate").alias("Year")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("disc"),
        F.sum(F.round(F.col("l_tax") * 100).cast("long")).alias("tax"),
        F.sum(F.col("l_quantity").cast("long")).alias("qty"),
        F.count_if(F.col("l_returnflag") == "A").alias("ret"),
        F.count_if(F.col("l_linestatus") == "F").alias("fin"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("price"),
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    j = pre.join(supplier, pre.l_suppkey == supplier.s_suppkey) \
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    j = j.where(~((F.col("n_nationkey") == UNSCORED[0]) & (F.col("Year") == UNSCORED[1])))
    g = j.groupBy("n_nationkey", "n_name", "r_name", "Year").agg(
        *[F.sum(c).alias(c) for c in ["n", "disc", "tax", "qty", "ret", "fin", "price"]])

    n = F.col("n")
    return g.select(
        english_name("n_name").alias("Country"),
        F.col("Year").cast("int").alias("Year"),
        F.col("r_name").alias("Region"),
        _ratio(F.col("disc") * 100, n, 100.0).alias("Happiness_Score"),
        _ratio(F.col("tax") * 100, n, 100.0).alias("GDP_Score"),
        _ratio(F.col("tax") * 50, n, 100.0).alias("Social_Score"),
        _ratio(F.col("qty") * 20, n, 100.0).alias("Health_Score"),
        _ratio(F.col("ret") * 1000, n, 100.0).alias("Freedom_Score"),
        _ratio(F.col("fin") * 1000, n, 100.0).alias("Generosity_Score"),
        F.when(~((F.col("n_nationkey") % 7 == 3) & (F.col("Year") == NULL_SCORE_YEAR)),
               _ratio(F.col("price"), n, 1_000_000.0)).alias("Corruption_Score"),
    )


def _ratio(num: Column, den: Column, scale: float) -> Column:
    """``(num div den) / scale``: integral division first, so the result is
    the same double in any engine."""
    return F.call_function("div", num.cast("long"), den.cast("long")).cast("double") / F.lit(scale)
