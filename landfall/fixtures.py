"""Input fixtures derived from the generated test tables.

The source data of the ETL (raw admissions, airport codes, code lists) is
not available, so its *shapes* are derived from the TPC-H-like tables with
Spark, over the whole tables, in exactly the way the oracle SQL derives them
in DuckDB (see ``landfall.queries``). Every derived edge value (missing
departure, ``D/S``, unknown mode, placeholder labels, ...) is a function of
the row's key, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.contracts import AIRPORT_COLUMNS, RAW_ADMISSIONS_COLUMNS  # fixed values: the inputs' column names
from landfall.functions.cleaning import SAS_EPOCH
from landfall.session import scratch_uri


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cases(subject: Column, mapping: list[tuple[int, object]]) -> Column:
    out = None
    for k, v in mapping:
        out = F.when(subject == k, F.lit(v)) if out is None else out.when(subject == k, F.lit(v))
    return out


def raw_admissions(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    """Admission records shaped like the SAS extract: doubles for numbers and
    day numbers, text for the admitted-until date.

    One row per order (orders joined to customers): the order date is the
    arrival, the customer's nation the citizenship. Every 10th row has no
    departure; ``dtaddto`` is ``D/S``, ``mm/dd/yyyy``, ``99999999`` or null
    for some keys, ``mmddyyyy`` otherwise; mode 7 and missing mode are
    unknown codes, as is visa 4. Every 7th order has a second record with the
    same ``cicid`` a day later; some orders have one without a ``cicid``, with
    a NaN ``cicid`` or with a NaN departure.

    ``full=True`` adds the other ten raw fields the fact carries (residence,
    port, address, age, visa post, birth year, gender, airline, admission
    and flight number; address and gender missing for some keys), in
    contract order, so the whole 20-column contract is exercised.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k, ck, nk, v = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey"), F.col("variant")
    wanted = [(0, F.lit(True)), (1, k % 7 == 0), (2, k % 35 == 0), (3, k % 49 == 0), (4, k % 77 == 1)]
    variants = F.array_compact(F.array(*[F.when(on, F.lit(i)) for i, on in wanted]))
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).withColumn("variant", F.explode(variants))
    nan = F.lit(float("nan"))
    day = F.datediff(F.to_date("o_orderdate"), F.lit(SAS_EPOCH).cast("date")) + (v == 1).cast("int")
    mode = _cases(k % 6, [(0, 1.0), (1, 2.0), (2, 3.0), (3, 9.0), (4, 7.0)])
    dtaddto = (F.when(k % 11 == 0, F.lit("D/S"))
                .when(k % 13 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
                .when(k % 17 == 0, F.lit("99999999"))
                .when(k % 19 == 0, F.lit(None).cast("string"))
                .otherwise(F.date_format("o_orderdate", "MMddyyyy")))
    cols = {
        "cicid": F.when(v == 3, nan).when(v != 2, k.cast("double")),
        "i94yr": F.year("o_orderdate").cast("double"),
        "i94mon": F.month("o_orderdate").cast("double"),
        "i94cit": nk.cast("double"),
        "arrdate": day.cast("double"),
        "i94mode": mode,
        "depdate": F.when(v == 4, nan).when(k % 10 != 0, (day + k % 30).cast("double")),
        "i94visa": (1 + k % 4).cast("double"),
        "dtaddto": dtaddto,
        "visatype": F.col("o_orderstatus"),
    }
    if full:
        cols.update({
            "i94res": ((nk + 1) % 25).cast("double"),
            "i94port": F.concat(F.lit("P"), (k % 300).cast("string")),
            "i94addr": F.when(k % 23 != 0, F.concat(F.lit("S"), (nk % 5).cast("string"))),
            "i94bir": (ck % 90).cast("double"),
            "visapost": F.substring("o_orderpriority", 3, 3),
            "biryear": (F.year("o_orderdate") - ck % 90).cast("double"),
            "gender": F.when(k % 3 == 0, F.lit("F")).when(k % 3 == 1, F.lit("M")),
            "airline": F.concat(F.lit("A"), (ck % 40).cast("string")),
            "admnum": (k * 1000 + 7).cast("double"),
            "fltno": (k % 9000).cast("string"),
        })
    return j.select(*[cols[name].alias(name) for name in RAW_ADMISSIONS_COLUMNS if name in cols])


def stored_admissions(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    """The raw admissions as a source of the fact: written to Parquet and read
    back, so that the fact's rules run over stored columns and not over the
    expressions that derive them."""
    raw, uri = raw_admissions(spark, sf_dir, full), scratch_uri(spark, "raw-admissions")
    raw.write.parquet(uri)
    return spark.read.schema(raw.schema).parquet(uri)


def _airport_columns(full: bool) -> dict[str, Column]:
    key, nk = F.col("c_custkey"), F.col("c_nationkey")
    cols = {
        "ident": F.col("c_name"),
        "iso_country": F.when(nk % 2 == 0, "US").otherwise("CA"),
        "iso_region": F.when(key % 9 == 0, "US").otherwise(F.concat(F.lit("US-"), F.col("c_mktsegment"))),
        "iata_code": F.when(key % 3 == 0, F.concat(F.lit("P"), (key % 400).cast("string"))),
        "local_code": F.when(key % 2 == 0, F.concat(F.lit("P"), (key % 500).cast("string"))),
    }
    if full:
        cols.update({
            "type": F.when(key % 3 == 0, "large_airport").when(key % 3 == 1, "small_airport")
                     .otherwise("heliport"),
            "name": F.concat(F.lit("Airport "), key.cast("string")),
            "elevation_ft": (key % 5000).cast("string"),
            "continent": F.lit("NA"),
            "municipality": F.concat(F.lit("Town "), nk.cast("string")),
            "gps_code": F.concat(F.lit("G"), key.cast("string")),
            "coordinates": F.concat((key % 180).cast("string"), F.lit(", "), nk.cast("string")),
        })
    return cols


def raw_airports(spark: SparkSession, sf_dir: str, full: bool = False) -> DataFrame:
    """Airport rows shaped like the airport-codes CSV (all text): one per
    customer; even nations are 'US'; some regions lack the ``-``; a third have
    an iata code, half a local code, some both, some none; codes repeat.

    ``full=True`` gives all twelve columns of the file, in its order."""
    c = table(spark, sf_dir, "customer")
    cols = _airport_columns(full)
    return c.select(*[cols[n].alias(n) for n in AIRPORT_COLUMNS if n in cols])


def demographics_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics-shaped rows (city, state, race, n) from customers; the
    state is missing for nations divisible by 7."""
    c = table(spark, sf_dir, "customer")
    nk = F.col("c_nationkey")
    return c.select(
        nk.alias("city"),
        F.when(nk % 7 != 0, nk % 5).alias("state"),
        F.col("c_mktsegment").alias("race"),
        F.col("c_custkey").alias("n"),
    )


# ------------------------------------------------------------ code-list text
def country_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country list lines ``   <key> =  '<label>'``, one per customer (so the
    list grows with the data); labels cycle through the three placeholder
    kinds and real names (the market segment) with a trailing blank, some with
    a quote inside, some empty. Every 9th key has a second line, and every
    11th customer a line without a key, another without ``=``."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    name = F.col("c_mktsegment")
    label = (F.when(key % 5 == 0, F.concat(F.lit("INVALID: "), name))
              .when(key % 5 == 1, F.format_string("No Country Code (%d)", key))
              .when(key % 5 == 2, F.concat(F.lit("Collapsed "), name, F.lit(" (should not show)")))
              .when(key % 15 == 3, F.concat(name, F.lit("''S ")))
              .when(key % 25 == 4, F.lit(""))
              .otherwise(F.concat(name, F.lit(" "))))
    first = F.format_string("   %d =  '%s'", key, label)
    return _ordered_lines(c, key, [
        (F.lit(True), first), (key % 9 == 0, F.format_string("   %d =  'A SECOND LINE' ;", key)),
        (key % 11 == 0, F.lit("    =  'NO KEY'")), (key % 11 == 0, F.concat(F.lit("/* "), name))])


def _ordered_lines(rows: DataFrame, key: Column, lines: list[tuple[Column, Column]]) -> DataFrame:
    """``value`` lines by key, those of a row in the given order, where their
    condition holds: written, the files hold them in that order."""
    numbered = F.array(*[F.struct(cond.alias("on"), F.lit(i).alias("n"), line.alias("value"))
                         for i, (cond, line) in enumerate(lines)])
    return rows.select(key.alias("key"), F.inline(numbered)).where("on").orderBy("key", "n").select("value")


def port_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Port list lines ``   'S<key>' \\t=\\t'<place>'`` from ``supplier``:
    both kinds of placeholders, places without a comma, and ``<city>, N<nation>``
    over 97 cities, some with a quote inside. Every 9th key has a second line,
    every 8th supplier a line without a key."""
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    pad = F.lit("      ")
    city = F.concat(F.lit("PORT "), (key % 97).cast("string"), F.when(key % 5 == 0, "''S").otherwise(""))
    place = (F.when(key % 7 == 0, F.format_string("No PORT Code (%d)", key))
              .when(key % 7 == 1, F.concat(city, pad))
              .when(key % 7 == 2, F.concat(F.lit("Collapsed into "), city))
              .otherwise(F.concat(city, F.lit(", N"), F.col("s_nationkey").cast("string"), pad)))
    return _ordered_lines(s, key, [
        (F.lit(True), F.format_string("   'S%d' \t=\t'%s'", key, place)),
        (key % 9 == 0, F.format_string("   'S%d' \t=\t'A SECOND PORT, XX'", key)),
        (key % 8 == 0, F.lit("   '' \t=\t'NO KEY, NO'"))])


def state_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State list lines ``\t'<key>'='<name>'``, one per customer (the market
    segment as name), with a blank after the closing quote for even keys. Every
    10th key has a second line, every 13th customer a line without a key."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    tail = F.when(key % 2 == 0, F.lit(" ")).otherwise(F.lit(""))
    return _ordered_lines(c, key, [
        (F.lit(True), F.concat(F.format_string("\t'%d'='%s'", key, F.col("c_mktsegment")), tail)),
        (key % 10 == 0, F.format_string("\t'%d'='A SECOND STATE'", key)), (key % 13 == 0, F.lit("\t' '='NO KEY'"))])


def mode_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transport-mode list lines ``\t<key> = '<label>'``, one per order (so the
    list grows with the data), labels cycling through the four modes."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    label = _cases(key % 4, [(0, "Air"), (1, "Sea"), (2, "Land"), (3, "Not reported")])
    return o.select(F.format_string("\t%d = '%s'", key, label).alias("value"))


def visa_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visa list lines ``<key> = <label>`` (no quotes), one per customer, labels
    cycling through the three categories; some close with ``;``, and every 9th
    key has a second line."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    label = _cases(key % 3, [(0, "Business"), (1, "Pleasure"), (2, "Student")])
    end = F.when(key % 4 == 0, " ;").otherwise("")
    return _ordered_lines(c, key, [(F.lit(True), F.concat(F.format_string("%d = %s", key, label), end)),
                                   (key % 9 == 0, F.format_string("%d = Another", key))])


def dictionary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A data dictionary: the five lists as sections of one text, the visa list
    inside a comment, with other lines and comments between them. In order of
    the columns ``part``, ``n`` and ``value``."""
    def rows(part, text):
        return spark.range(1).select(F.lit(part).alias("part"), F.lit(0).cast("long").alias("n"), F.lit(text).alias("value"))

    def entries(part, table_name, key, line):
        return table(spark, sf_dir, table_name).select(F.lit(part).alias("part"), F.col(key).cast("long").alias("n"), line.alias("value"))

    c, k = F.col("c_mktsegment"), F.col("c_custkey")
    s, o = F.col("s_suppkey"), F.col("o_orderkey")
    mode = _cases(o % 4, [(0, "Air"), (1, "Sea"), (2, "Land"), (3, "Not reported")])
    visa = _cases(k % 3, [(0, "Business"), (1, "Pleasure"), (2, "Student")])
    parts = [
        rows(0, "proc format library=library ;"), rows(1, "/* I94YR - 4 digit year */"), rows(2, "  value i94cntyl"),
        entries(3, "customer", "c_custkey", F.format_string("   %d =  '%s'", k, F.when(k % 5 == 0, F.concat(F.lit("INVALID: "), c)).otherwise(c))),
        rows(4, "   5 = 'A LATER LINE' ;"), rows(5, "   77 = 'OUTSIDE'"), rows(6, "/* I94PORT - codes */"), rows(7, "  value $i94prtl"),
        entries(8, "supplier", "s_suppkey", F.format_string("   'S%d'\t=\t'PORT %d, N%d     '", s, s % 97, F.col("s_nationkey"))),
        rows(9, ";"), rows(10, "value i94model"), entries(11, "orders", "o_orderkey", F.format_string("\t%d = '%s'", o, mode)),
        rows(12, ";"), rows(13, "/* I94ADDR - many invalid codes, the list"), rows(14, "   shows those that 1 = 'are valid' */"), rows(15, "value i94addrl"),
        entries(16, "customer", "c_custkey", F.format_string("\t'%d'='%s'", k, c)), rows(17, "\t'99999999'='All Other Codes' ;"),
        rows(18, "/* I94VISA - categories:"), entries(19, "customer", "c_custkey", F.format_string("   %d = %s", k, visa)), rows(20, "*/"),
        rows(21, "/* COUNT - 1 = 'no list' */"), rows(22, "run ;")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_dictionary(spark: SparkSession, sf_dir: str) -> str:
    """The dictionary as one file (a list of codes; its order is its meaning)."""
    uri = scratch_uri(spark, "dictionary")
    dictionary_lines(spark, sf_dir).orderBy("part", "n", "value").select("value").coalesce(1).write.text(uri)
    return uri


def broken_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the ';' demographics file, one per customer: every 50th has too
    few fields, every 51st too many; text and fractions stand in number columns
    of others, some of which are empty or blank."""
    k = F.col("c_custkey")
    number = lambda c, bad: F.when(bad, c).otherwise((k % 1000).cast("string"))
    fields = [F.col("c_name"), F.concat(F.lit("State "), (F.col("c_nationkey") % 5).cast("string")),
              number(F.lit("n/a"), k % 7 == 1), number(F.lit("12.5"), k % 11 == 2), number(F.lit(" 7 "), k % 13 == 3),
              number(F.lit("many"), k % 7 == 4), number(F.lit(""), k % 17 == 5), number(F.lit("99999999999"), k % 19 == 6),
              number(F.lit("1e1"), k % 23 == 7), F.lit("S"), F.col("c_mktsegment"), number(F.lit("-3"), k % 29 == 8)]
    line = F.concat_ws(";", *fields)
    few = F.concat_ws(";", *fields[:9])
    return table(spark, sf_dir, "customer").select(
        F.when(k % 50 == 0, few).when(k % 51 == 0, F.concat(line, F.lit(";more"))).otherwise(line).alias("value"))


def write_lines(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Write text lines to a fresh scratch location; returns its URI."""
    uri = scratch_uri(spark, name)
    lines.write.text(uri)
    return uri


def demographics_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the 12-column city-demographics file, one per customer, with the
    source's header names (blanks and dashes); the state is missing for
    nations divisible by 7 and keys repeat (several customers per nation)."""
    c = table(spark, sf_dir, "customer")
    nk, ck = F.col("c_nationkey"), F.col("c_custkey")
    return c.select(
        F.concat(F.lit("City "), nk.cast("string")).alias("City"),
        F.when(nk % 7 != 0, F.concat(F.lit("State "), (nk % 5).cast("string"))).alias("State"),
        ((ck % 600).cast("double") / 10).alias("Median Age"),
        (ck % 1000).cast("int").alias("Male Population"),
        (ck % 1100).cast("int").alias("Female Population"),
        (ck % 1000 + ck % 1100).cast("int").alias("Total Population"),
        (ck % 90).cast("int").alias("Number of Veterans"),
        (ck % 300).cast("int").alias("Foreign-born"),
        ((ck % 500).cast("double") / 100).alias("Average Household Size"),
        F.concat(F.lit("S"), (nk % 5).cast("string")).alias("State Code"),
        F.col("c_mktsegment").alias("Race"),
        ck.cast("int").alias("Count"),
    )


def write_star_inputs(spark: SparkSession, sf_dir: str):
    """Write every raw input of the star build (CSV, text lists, Parquet
    admissions), derived from the test tables, to scratch; returns the
    ``StarInputs`` pointing at them."""
    from landfall.plans.star import StarInputs

    airports = scratch_uri(spark, "airport-codes")
    raw_airports(spark, sf_dir, full=True).write.option("header", "true").csv(airports)
    demo = scratch_uri(spark, "demographics")
    demographics_source(spark, sf_dir).write.option("header", "true").option("sep", ";").csv(demo)
    adm = scratch_uri(spark, "admissions")
    raw_admissions(spark, sf_dir, full=True).write.parquet(adm)
    return StarInputs(
        airports_csv=airports,
        demographics_csv=demo,
        country_list=write_lines(spark, country_lines(spark, sf_dir), "country-list"),
        port_list=write_lines(spark, port_lines(spark, sf_dir), "port-list"),
        state_list=write_lines(spark, state_lines(spark, sf_dir), "state-list"),
        admissions=adm,
    )
