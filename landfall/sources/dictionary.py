"""Code lists straight from a data dictionary: one text with many sections.

    value <name>            a list: entries up to a line that ends with ``;``
      <k> = '<label>'
      <k> = '<label>' ;
    /* <name> - words       a list inside a comment, up to the line with the
       <k> = <label>        comment's end
    */

The text is read in splits, as any text. What a line belongs to depends on the
last line before it that opens or closes a section, perhaps in an earlier split:
the few such lines are gathered per split, the state that a split ends with is
carried to the next splits of its file, and every line looks its state up.
Nothing passes through the driver, and no split waits for another.

Defined cases: entries outside sections and sections that nobody asked for are
skipped; a name may be quoted by ``$`` (character formats) and is compared
without regard to case; an opening line ends the section before it; a comment
that opens and closes on one line holds no entries; sections of one name in
several places are one list, of equal keys the first line wins; a file's end
closes its sections.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.cleaning import trim_ws
from landfall.operators.relational import drop_null_keys, keep_first
from landfall.session import scratch_uri
from landfall.sources.codelists import COUNTRY_PLACEHOLDERS, PORT_PLACEHOLDERS, parse_codelist, split_place

# Names of the lists in the admissions data dictionary.
SECTIONS = {"country": "i94cntyl", "port": "i94prtl", "mode": "i94model", "state": "i94addrl", "visa": "i94visa"}

_PLACE = ["_file", "_block", "_line"]


def _marks(line: Column) -> tuple[Column, Column]:
    """(whether a line opens or closes a section, the name open after it)."""
    text = trim_ws(line)
    name = F.regexp_extract(text, r"^(?i:value)\s+\$?(\w+)", 1)
    comment = F.regexp_extract(text, r"^/\*\s*(\w+)\s+-", 1)
    ends = text.endswith(";") | F.contains(text, F.lit("*/"))
    opens = (name != "") | text.startswith("/*")
    return opens | ends, F.when(ends, F.lit(None)).when(name != "", F.lower(name)).when(comment != "", F.lower(comment))


def section_lines(spark: SparkSession, uri: str | Sequence[str]) -> DataFrame:
    """(section, value, _file, _block, _line): the lines inside sections, with
    their section's name in lower case and their place. The numbered lines are
    written once, so that their numbers stay what they are."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
             F.monotonically_increasing_id().alias("_line")]  # ascends within a block
    written = scratch_uri(spark, "dictionary-lines")
    marked, opened = _marks(F.col("value"))
    numbered = spark.read.text(uri).select("value", *place).select(
        "*", marked.alias("_mark"), F.when(marked, opened).alias("_name"))
    numbered.write.parquet(written)
    lines = spark.read.schema(numbered.schema).parquet(written)
    marks = lines.where("_mark").groupBy("_file", "_block").agg(
        F.sort_array(F.collect_list(F.struct("_line", "_name"))).alias("_marks"))
    ends = F.struct("_block", F.element_at("_marks", -1)["_name"].alias("_name"))
    carried = marks.groupBy(F.col("_file").alias("_c_file")).agg(F.sort_array(F.collect_list(ends)).alias("_ends"))
    before = lambda items, field, at: F.element_at(  # noqa: E731 - the last item before a place
        F.concat(F.array(F.lit(None).cast("string")), F.transform(
            F.filter(items, lambda m: m[field] < at), lambda m: m["_name"])), -1)
    splits = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n")).join(
        carried, F.col("_file") == F.col("_c_file"), "left").join(marks, ["_file", "_block"], "left").select(
        F.col("_file").alias("_s_file"), F.col("_block").alias("_s_block"),
        F.coalesce("_marks", F.array().cast(marks.schema["_marks"].dataType)).alias("_marks"),
        F.when(F.col("_ends").isNotNull(), before(F.col("_ends"), "_block", F.col("_block"))).alias("_open"))
    known = lines.where("NOT _mark OR contains(value, '=')").join(
        splits, (F.col("_file") == F.col("_s_file")) & (F.col("_block") == F.col("_s_block")))
    inside = F.filter("_marks", lambda m: m["_line"] < F.col("_line"))
    section = F.when(F.size(inside) > 0, F.element_at(inside, -1)["_name"]).otherwise(F.col("_open"))
    return known.select(section.alias("section"), "value", *_PLACE).where("section IS NOT NULL")


def read_section(lines: DataFrame, section: str, key: str, label: str, key_type: str = "string",
                 placeholders: Sequence[str] = ()) -> DataFrame:
    """(key, label) of one list of :func:`section_lines`: null keys dropped, the
    first line of a key."""
    own = lines.where(F.col("section") == section.lower())
    parsed = drop_null_keys(parse_codelist(own, key, label, key_type, placeholders, keep=_PLACE), [key])
    return keep_first(parsed, [key], _PLACE).select(key, label)


def read_dictionary(spark: SparkSession, uri: str | Sequence[str], sections: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """The five lists of a dictionary, as ``read_country`` and its siblings give
    them: country, port, mode, state, visa. ``sections`` renames sections."""
    names = SECTIONS | (sections or {})
    lines = section_lines(spark, uri)
    return {
        "country": read_section(lines, names["country"], "country_code", "country", "long", COUNTRY_PLACEHOLDERS),
        "port": split_place(read_section(lines, names["port"], "port_of_entry", "place", "string", PORT_PLACEHOLDERS)),
        "mode": read_section(lines, names["mode"], "transport_code", "mode", "long"),
        "state": read_section(lines, names["state"], "state_code", "state"),
        "visa": read_section(lines, names["visa"], "visa_code", "visa", "long"),
    }
