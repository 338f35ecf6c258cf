"""The query catalog: one entry per operator of the survey's inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables (or over what Spark derives from them: the landed
reference-shaped inputs and the written star). Limits appear only where the
limit is the operator (top-k, head/tail, preview slice, sample).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.paths import in_year
from tallystar.functions.strings import (
    decode_map,
    leading_int,
    replace_chain,
    safe_int,
    strict_int,
    strip_ws,
)
from tallystar.operators import clean, profile, quality, sketches, star
from tallystar.operators.names import suggest_renames
from tallystar.operators.rank import rank_within
from tallystar.plans import bindings as B
from tallystar.plans import landing as L
from tallystar.plans import marts as M
from tallystar.plans.model import (
    AGE_LABEL_CHAIN,
    COUNTRY_RENAMES,
    FACT_CONTRACT,
    HAPPINESS_COLS,
    RAW_FIELDS,
    RAW_SCHEMA,
)
from tallystar.plans.star_build import (
    clean_records,
    conform_yearly,
    decode_coverage,
    files_by_layout,
    list_inputs_deep,
    one_per_country,
    read_yearly_layouts,
    reject_counts,
)
from tallystar.session import fresh_path
from tallystar.sources.json_ranges import read_keyed_json_ranges
from tallystar.sources.readers import (
    read_csv_exact,
    read_csv_strings,
    read_keyed_json,
    read_sections,
    with_file_year,
)
from tallystar.sources.sinks import write_by_year, write_csv

Query = Callable[[SparkSession, str], DataFrame]

FOCUS_YEAR = 1998
# F7 preview: the reference looked at five keys at each of three offsets.
SLICE_STARTS = (100, 300, 400)
SLICE_LENGTH = 5
SAMPLE_FRACTION = 0.1
SAMPLE_ROWS = 10
# Stand-in harmonise list: nations 20-24 are second spellings of nations 0-4,
# plus the reference's own renames (which do not occur in the stand-in).
STANDIN_RENAMES = {**{f"Nation_{20 + i}": f"Nation_{i}" for i in range(5)}, **COUNTRY_RENAMES}
EN_NAMES = {"Geslacht": "GenderCode", "LeeftijdOp31December": "AgeCode",
            "BurgerlijkeStaat": "MaritalCode", "Geboorteland": "CountryCode",
            "Perioden": "PeriodCode", "Immigratie_1": "ImmigrationVolume"}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return B.table(spark, sf, name)


def _star(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return L.star_tables(spark, sf)


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Raw records (the reference's seven fields), from the landed copy."""
    return L.landed_raw_table(spark, L.land_inputs(spark, sf))


def _codes(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return L.landed_code_lists(spark, L.land_inputs(spark, sf))


# ------------------------------------------------------------------- marts
def mart_topk_with_score(spark, sf):
    fact, dim = _star(spark, sf)
    return M.topk_with_score(fact, dim, FOCUS_YEAR, 10)


def mart_profile(spark, sf):
    fact, _ = _star(spark, sf)
    return M.age_profile(fact, ("Year", "Age"))


def mart_profile_split(spark, sf):
    fact, _ = _star(spark, sf)
    return M.age_profile(fact, ("Year", "Gender", "Age"))


def mart_correlation(spark, sf):
    fact, dim = _star(spark, sf)
    return M.score_volume_correlation(fact, dim)


def mart_trend_pivot(spark, sf):
    fact, _ = _star(spark, sf)
    return M.trend_pivot(fact, M.partition_years(fact))


def mart_topk_per_year(spark, sf):
    fact, dim = _star(spark, sf)
    return M.topk_per_year(fact, dim, 10)


def mart_trend_country(spark, sf):
    fact, _ = _star(spark, sf)
    return M.trend_pivot(fact, M.partition_years(fact), key="Country")


def mart_trend_gender(spark, sf):
    fact, _ = _star(spark, sf)
    return M.trend_pivot(fact, M.partition_years(fact), key="Gender")


def fact_build(spark, sf):
    """M5 as a plan (``L.star_tables`` has it as written, ``dq_rejects`` the rest of that write)."""
    return L.landed_fact(spark, L.land_inputs(spark, sf))


def dimension_build(spark, sf):
    return L.landed_dimension(spark, L.land_inputs(spark, sf))


# -------------------------------------------------------------- aggregates
def agg_sum_by_key(spark, sf):
    fact, _ = _star(spark, sf)
    return M.volume_by(fact, ["Country"])


def agg_row_counts(spark, sf):
    fact, _ = _star(spark, sf)
    parts = [_t(spark, sf, n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n in ["lineitem", "orders", "customer", "part"]]
    parts.append(fact.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("fact").alias("table_name"), "n_rows"))
    return star.union_all(parts)


def agg_dedup(spark, sf):
    return clean.dedup_first(clean_records(_raw(spark, sf), B.STANDIN_BOOK), ["ID"])


def win_rank(spark, sf):
    _, dim = _star(spark, sf)
    return rank_within(dim.select("Country", "Year", "Happiness_Score"), ["Year"],
                       "Happiness_Score", ["Country"])


def topk(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return profile.head(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


# ----------------------------------------------------------------- filters
def filt_measure(spark, sf):
    return clean.keep_positive(_raw(spark, sf), "Immigratie_1")


def filt_code_range(spark, sf):
    return _raw(spark, sf).where(clean.code_below("LeeftijdOp31December", B.STANDIN_AGE_BAND_LIMIT))


def filt_drop_totals(spark, sf):
    raw = clean.trim_columns(_raw(spark, sf), ["Geslacht", "LeeftijdOp31December",
                                                "BurgerlijkeStaat", "Geboorteland"])
    return clean.drop_totals(raw, B.STANDIN_TOTALS)


def filt_conjunction(spark, sf):
    fact, _ = _star(spark, sf)
    return fact.where((F.col("Year") == FOCUS_YEAR) & (F.col("SingleCountry") == "Y"))


def filt_partition(spark, sf):
    fact, _ = _star(spark, sf)
    return fact.where(F.col("Year") == FOCUS_YEAR)


def filt_key_slice(spark, sf):
    """On an integral key (pushed to the scan) and on the same key as text, as
    the JSON map keys are, zero-padded to 24 digits."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    text = o.withColumn("key_text", F.lpad(F.col("o_orderkey").cast("string"), 24, "0"))
    return clean.key_slice(o, "o_orderkey", SLICE_STARTS, SLICE_LENGTH).withColumn("key_kind", F.lit("number")) \
        .unionByName(clean.key_slice(text, "key_text", SLICE_STARTS, SLICE_LENGTH).drop("key_text")
                     .withColumn("key_kind", F.lit("text")))


def map_lookup(spark, sf):
    ev = _t(spark, sf, "events")
    props = F.from_json("props", "map<string,int>")
    return ev.select("event_id", F.try_element_at(props, F.lit("k")).alias("k"))


def json_map_explode(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", F.from_json("props", "map<string,int>").alias("m"))
    return ev.select("event_id", F.size("m").alias("n_keys"), F.explode("m").alias("key", "value"))


# ------------------------------------------------------------------- joins
def join_star_decode(spark, sf):
    recs = clean_records(_raw(spark, sf), B.STANDIN_BOOK)
    dims = _codes(spark, sf)
    f = recs
    f = star.decode(f, dims["gender"], "Geslacht", "GeslachtCode", ["Gender"])
    f = star.decode(f, dims["age"], "LeeftijdOp31December", "LeeftijdCode", ["Age"])
    f = star.decode(f, dims["marital"], "BurgerlijkeStaat", "BurgerlijkeStaatCode", ["MaritalStatus"])
    f = star.decode(f, dims["country"], "Geboorteland", "LandCode", ["Land"])
    f = star.decode(f, dims["period"], "Perioden", "PeriodeCode", ["Year"])
    return f.select("ID", "Gender", leading_int("Age").alias("Age"), "MaritalStatus", "Land",
                    safe_int("Year").alias("Year"), "Immigratie_1")


def join_two_hop(spark, sf):
    land = L.land_inputs(spark, sf)
    recs = clean.trim_columns(_raw(spark, sf).select("ID", "Geboorteland"), ["Geboorteland"])
    dims = _codes(spark, sf)
    f = star.decode(recs, dims["country"], "Geboorteland", "LandCode", ["Land"])
    tr = read_csv_strings(spark, land.translation)
    f = star.decode(f, tr, "Land", "Land_Dutch", ["Country", "SingleCountry"])
    return f.select("ID", "Geboorteland", "Land", "Country", "SingleCountry")


def join_coverage_anti(spark, sf):
    return star.coverage(_t(spark, sf, "orders"), _t(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


def join_coverage_codes(spark, sf):
    """D17 beside the decodes: codes of the cleaned records no code list or
    translation covers, with their records."""
    land = L.land_inputs(spark, sf)
    return decode_coverage(clean_records(_raw(spark, sf), B.STANDIN_BOOK), _codes(spark, sf),
                           read_csv_strings(spark, land.translation))


def join_coverage_scores(spark, sf):
    """Countries with immigrants in a year but no score that year: the rows
    the top-k join drops."""
    fact, dim = _star(spark, sf)
    return star.coverage_keys(fact, dim, ["Country", "Year"])


def join_rename_suggestions(spark, sf):
    """Countries of the dimension that no row of the translation names alike,
    with the three most similar names there."""
    _, dim = _star(spark, sf)
    return suggest_renames(dim, read_csv_strings(spark, L.land_inputs(spark, sf).translation), "Country", "Land_Dutch")


# ---------------------------------------------------------------- profiles
def profile_nulls(spark, sf):
    return profile.null_counts(_raw(spark, sf))


def profile_distinct(spark, sf):
    li = _t(spark, sf, "lineitem")
    return profile.distinct_counts(li, ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag",
                                        "l_linestatus", "l_quantity"], exact=True)


def profile_distinct_sketched(spark, sf):
    """A7 by one stored sketch a year and column, merged at read. Below some hundred
    distinct values, as here, the estimate is the count."""
    fact, _ = _star(spark, sf)
    path = fresh_path(spark, "sketches")
    write_by_year(sketches.year_sketches(fact, ["Gender", "Age", "MaritalStatus", "Country", "SingleCountry"]), path)
    return sketches.merged_counts(spark.read.parquet(path))


def profile_distinct_values(spark, sf):
    fact, _ = _star(spark, sf)
    return profile.distinct_values(fact, "Country")


def profile_describe(spark, sf):
    li = _t(spark, sf, "lineitem")
    return profile.describe(li, ["l_quantity", "l_discount", "l_tax"], exact=True)


def profile_describe_distinct(spark, sf):
    """A8 on doubles that are nearly all distinct: exact quartiles keep no value map."""
    li = _t(spark, sf, "lineitem")
    price = F.col("l_extendedprice")
    return profile.describe(li.select((price / (F.col("l_orderkey") * 8 + F.col("l_linenumber"))).alias("price_per_key"),
                                      (F.col("l_partkey") / price).alias("part_per_price")),
                            ["price_per_key", "part_per_price"], exact=True)


def profile_describe_dim(spark, sf):
    """A8 on the happiness dimension's scores, as the reference profiled them."""
    _, dim = _star(spark, sf)
    return profile.describe(dim, [c for c in HAPPINESS_COLS if c.endswith("_Score")], exact=True)


def profile_nulls_dim(spark, sf):
    _, dim = _star(spark, sf)
    return profile.null_counts(dim.select(*HAPPINESS_COLS))


def head_tail(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    h = profile.head(p, ["p_partkey"], 5).withColumn("side", F.lit("head"))
    t = profile.tail(p, ["p_partkey"], 5).withColumn("side", F.lit("tail"))
    c = profile.cell(p, ["p_partkey"], 1, *p.columns).withColumn("side", F.lit("cell"))
    return star.union_all([h, t, c]).select("side", "p_partkey", "p_type", "p_size")


def sample_rows(spark, sf):
    return profile.sample_rows(_t(spark, sf, "orders"), SAMPLE_FRACTION, seed=42)


def sample_rows_by_key(spark, sf):
    return profile.sample_by_key(_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                                 "o_orderkey", SAMPLE_FRACTION)


def sample_n(spark, sf):
    return profile.sample_n(_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                            "o_orderkey", SAMPLE_ROWS)


def set_difference_both(spark, sf):
    """U3 both ways: customers only in 1998 and only in 1999."""
    o = _t(spark, sf, "orders")
    a = o.where(in_year("o_orderdate", 1998))
    b = o.where(in_year("o_orderdate", 1999))
    return star.except_keys(a, b, ["o_custkey"]).withColumn("side", F.lit("only_1998")).unionByName(
        star.except_keys(b, a, ["o_custkey"]).withColumn("side", F.lit("only_1999")))


def set_except(spark, sf):
    o = _t(spark, sf, "orders")
    a = o.where(in_year("o_orderdate", 1998))
    b = o.where(in_year("o_orderdate", 1999))
    return star.except_keys(a, b, ["o_custkey"])


# ----------------------------------------------------------------- quality
def dq_report(spark, sf):
    fact, _ = _star(spark, sf)
    return quality.quality_report(fact, "ImmigrationVolume")


def dq_duplicates(spark, sf):
    return quality.duplicate_report(_raw(spark, sf), ["ID"])


def dq_domain(spark, sf):
    fact, _ = _star(spark, sf)
    rules = {
        "gender_known": F.col("Gender").isin("Men", "Women"),
        "age_0_105": F.col("Age").between(0, 105),
        "volume_positive": F.col("ImmigrationVolume") > 0,
        "flag_y_n": F.col("SingleCountry").isin("Y", "N"),
    }
    return quality.domain_report(fact, rules)


def dq_domain_dim(spark, sf):
    _, dim = _star(spark, sf)
    scores = [c for c in HAPPINESS_COLS if c.endswith("_Score")]
    return quality.domain_report(dim, {f"{c}_0_10": F.col(c).between(0, 10) for c in scores})


def dq_schema(spark, sf):
    fact, _ = _star(spark, sf)
    return quality.schema_report(fact, FACT_CONTRACT)


def dq_key_unique(spark, sf):
    """After harmonising names, which (Country, Year) keys repeat."""
    _, dim = _star(spark, sf)
    h = clean.harmonise_values(dim.select("Country", "Year"), "Country", STANDIN_RENAMES)
    return star.key_unique(h, ["Country", "Year"])


def dq_reconcile(spark, sf):
    """Records per year in the files against the dimension after harmonising
    names (merged spellings make the years differ)."""
    land = L.land_inputs(spark, sf)
    records = conform_yearly(read_yearly_layouts(spark, files_by_layout(list_inputs_deep(spark, land.happiness), B.standin_layout)))
    dim = clean.harmonise_values(records, "Country", STANDIN_RENAMES)
    return quality.reconcile(records, one_per_country(dim, "mean"), "Year")


def dq_rejects(spark, sf):
    """What the one written build kept and dropped, by step."""
    return reject_counts(L.built(spark, sf))


# ------------------------------------------------------- strings / scalars
def str_trim_replace(spark, sf):
    d = _t(spark, sf, "documents")
    return d.select("doc_id", replace_chain("text", AGE_LABEL_CHAIN).alias("text_clean"))


def str_harmonise(spark, sf):
    _, dim = _star(spark, sf)
    h = clean.harmonise_values(dim.select("Country", "Year", "Happiness_Score"), "Country", STANDIN_RENAMES)
    r = star.resolve_duplicates(h, ["Country", "Year"], ["Happiness_Score"], how="mean")
    return r.select("Country", "Year", F.round("Happiness_Score", 6).alias("Happiness_Score"), "n_merged")


def proj_select_rename(spark, sf):
    return _raw(spark, sf).select(*RAW_FIELDS).withColumnsRenamed(EN_NAMES)


def proj_constant(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", "p_size").withColumn("Year", F.lit(2018))


def proj_decode_map(spark, sf):
    raw = _raw(spark, sf)
    return raw.select("ID", "Geslacht", decode_map("Geslacht", B.STANDIN_BOOK.gender_en).alias("Gender"),
                      decode_map(strip_ws("BurgerlijkeStaat"), B.STANDIN_BOOK.marital_en).alias("MaritalStatus"))


def proj_safe_cast(spark, sf):
    """Text of every form: whole, 10-digit, signed, padded, fractional, malformed."""
    li = _t(spark, sf, "lineitem")
    form = F.col("l_partkey") % 11
    text = (F.when(form == 0, "2000000000").when(form == 1, "-7").when(form == 2, "0000000000042")
            .when(form == 3, "3000000000").when(form == 4, "x1").when(form == 5, " 12 ").when(form == 6, "12.9")
            .otherwise(F.col("l_quantity").cast("string")))
    return li.select("l_orderkey", "l_linenumber", text.alias("qty_text")).select(
        "l_orderkey", "l_linenumber", "qty_text", strict_int("qty_text").alias("qty_direct"),
        safe_int("qty_text").alias("qty_int"))


# --------------------------------------------------------- sources / sinks
def src_year_from_path(spark, sf):
    land = L.land_inputs(spark, sf)
    recs = read_keyed_json(spark, land.imm, RAW_SCHEMA, keep_year=True)
    return recs.groupBy("Year").agg(F.count(F.lit(1)).alias("n_records"))


def src_keyed_json(spark, sf):
    return L.landed_raw(spark, L.land_inputs(spark, sf))


def src_keyed_json_ranges(spark, sf):
    """S2 by byte ranges: as many tasks as splits, however large a document is."""
    return read_keyed_json_ranges(spark, L.land_inputs(spark, sf).imm, RAW_SCHEMA).drop("key")


def src_sectioned(spark, sf):
    land = L.land_inputs(spark, sf)
    return read_sections(spark, land.codes).select("section", "Key", "Title")


def src_csv_typed(spark, sf):
    """Both layouts, by name: further columns ignored, ``N/A`` as NULL."""
    land = L.land_inputs(spark, sf)
    files = files_by_layout(list_inputs_deep(spark, land.happiness), B.standin_layout)
    return star.union_all([conform_yearly({lay: df}).withColumn("layout", F.lit(lay))
                           for lay, df in read_yearly_layouts(spark, files).items()])


def src_csv_strings(spark, sf):
    return read_csv_strings(spark, L.land_inputs(spark, sf).translation)


def conform_union(spark, sf):
    land = L.land_inputs(spark, sf)
    files = files_by_layout(list_inputs_deep(spark, land.happiness), B.standin_layout)
    return conform_yearly(read_yearly_layouts(spark, files))


def scan_parquet_partitioned(spark, sf):
    fact, _ = _star(spark, sf)
    return fact


def sink_csv_roundtrip(spark, sf):
    _, dim = _star(spark, sf)
    path = fresh_path(spark, "export-csv")
    write_csv(dim, path)
    return read_csv_exact(spark, path, dim.schema)


def sink_parquet_roundtrip(spark, sf):
    fact, _ = _star(spark, sf)
    path = fresh_path(spark, "export-parquet")
    write_by_year(fact, path)
    return spark.read.parquet(path)


def sink_dynamic_overwrite(spark, sf):
    _, dim = _star(spark, sf)
    path = fresh_path(spark, "refresh")
    write_by_year(dim, path)
    # the year comes back with other values; the other years stay
    new = dim.where(F.col("Year") == FOCUS_YEAR).withColumn("Happiness_Score", F.col("Happiness_Score") + 1)
    write_by_year(new, path, refresh=True)
    return spark.read.parquet(path)


def stream_yearly_refresh(spark, sf):
    """K3 run as a stream over the landed yearly files, then read back."""
    from tallystar.streaming.refresh import start_refresh
    land = L.land_inputs(spark, sf)
    out, ckpt = fresh_path(spark, "refresh-stream"), fresh_path(spark, "refresh-ckpt")
    q = start_refresh(spark, land.happiness, out, ckpt, B.standin_layout, max_files_per_trigger=3)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(out)


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    mart_topk_with_score, mart_profile, mart_profile_split, mart_correlation, mart_trend_pivot,
    mart_topk_per_year, mart_trend_country, mart_trend_gender,
    fact_build, dimension_build,
    agg_sum_by_key, agg_row_counts, agg_dedup, win_rank, topk,
    filt_measure, filt_code_range, filt_drop_totals, filt_conjunction, filt_partition,
    filt_key_slice, map_lookup, json_map_explode,
    join_star_decode, join_two_hop, join_coverage_anti, join_coverage_scores,
    join_coverage_codes, join_rename_suggestions,
    profile_nulls, profile_distinct, profile_distinct_sketched, profile_distinct_values, profile_describe,
    profile_describe_distinct, profile_describe_dim, profile_nulls_dim, head_tail, sample_rows,
    sample_rows_by_key, sample_n, set_except, set_difference_both,
    dq_report, dq_duplicates, dq_domain, dq_domain_dim, dq_reconcile, dq_rejects, dq_schema,
    dq_key_unique,
    str_trim_replace, str_harmonise, proj_select_rename, proj_constant, proj_decode_map, proj_safe_cast,
    src_year_from_path, src_keyed_json, src_keyed_json_ranges, src_sectioned, src_csv_typed, src_csv_strings, conform_union,
    scan_parquet_partitioned, sink_csv_roundtrip, sink_parquet_roundtrip, sink_dynamic_overwrite,
    stream_yearly_refresh,
]}
