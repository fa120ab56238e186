"""Amounts and the units that are told for them, in a result text or else in the unit column (problem 7); ``unit_switches`` decodes from these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fenced

#: Spellings (lower case, without spaces, dots, brackets and degree signs) of unit codes.
SPELLINGS = {
    "mmHg": ("mmhg", "millimetersofmercury"), "kPa": ("kpa", "kilopascal", "kilopascals"), "cmH2O": ("cmh2o", "cmhho"),
    "degC": ("degc", "c", "celsius", "degreesc", "degreescelsius", "degcelsius", "centigrade"), "degF": ("degf", "f", "fahrenheit", "degreesf", "degreesfahrenheit", "degfahrenheit"),
    "kg": ("kg", "kgs", "kilo", "kilos", "kilogram", "kilograms"), "g": ("g", "gm", "gms", "gr", "gram", "grams"), "lb": ("lb", "lbs", "pound", "pounds"), "oz": ("oz", "ounce", "ounces"),
    "cm": ("cm", "cms", "centimeter", "centimeters", "centimetre", "centimetres"), "m": ("m", "mtr", "mtrs", "meter", "meters", "metre", "metres"), "in": ("in", "inch", "inches", '"', "″"), "ft": ("ft", "foot", "feet", "'", "′"),
    "mg/dL": ("mg/dl", "mg/100ml"), "mmol/L": ("mmol/l",), "umol/L": ("umol/l",),
    "mL": ("ml", "mls", "cc", "ccs", "milliliter", "milliliters", "millilitre", "millilitres"), "L": ("l", "ltr", "liter", "liters", "litre", "litres"), "dL": ("dl", "deciliter", "deciliters", "decilitre", "decilitres"), "fl_oz": ("floz", "fl_oz", "fluidounce", "fluidounces"),
}
#: Words before an amount that make it a bound.
BOUNDS = r"(^|[^a-z])(min|max|minimum|maximum|under|over|less|more|below|above|least|most|up|greater|exceeds)([^a-z]|$)"
NUMBER = r"[0-9]+(?:[.,][0-9]+)*"
LEAD = r"^([a-z ~:.]*?)\s*"
TAIL = r"\s*([^0-9,;(]*?)\s*(?:[,;(][^0-9]*)?$"
SINGLE = LEAD + f"({NUMBER})" + TAIL
FEET = LEAD + f"({NUMBER})" + r"\s*(?:ft|foot|feet|'|′|’)\.?\s*" + f"({NUMBER})" + r"\s*(?:inches|inch|in|''|\"|″|”)?\.?\s*(?:[,;(][^0-9]*)?$"
POUNDS = LEAD + f"({NUMBER})" + r"\s*(?:lbs|lb|pounds|pound)\.?\s*" + f"({NUMBER})" + r"\s*(?:ounces|ounce|oz)\.?\s*(?:[,;(][^0-9]*)?$"


def unit_code(text: Column) -> Column:
    """The unit code of a unit text; null for texts that name no unit."""
    t = F.lower(text)
    t = F.regexp_replace(t, "[µμ]|micro", "u")
    t = F.regexp_replace(t, r"\sper\s", "/")
    t = F.regexp_replace(t, r"[\s.\[\]°]", "")
    table = F.create_map(*(F.lit(x) for code, words in SPELLINGS.items() for w in words for x in (w, code)))
    return F.when(t != "", F.element_at(table, t))


def number(text: Column, decimal_mark: Column) -> Column:
    """The value of digits with marks.

    A mark that is repeated, or that splits off groups of three after one to three digits not starting
    with 0, could be a thousands mark; then the source's decimal mark decides (a point without one). Of
    two different marks the last is the decimal one.
    """
    mark = F.when(decimal_mark == ",", ",").otherwise(".")
    comma, point = F.instr(text, ",") > 0, F.instr(text, ".") > 0
    last_comma = F.instr(F.reverse(text), ",") < F.instr(F.reverse(text), ".")
    as_comma = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    as_point = F.replace(text, F.lit(","), F.lit(""))
    grouped_comma, grouped_point = text.rlike(r"^[1-9][0-9]{0,2}(,[0-9]{3})+$"), text.rlike(r"^[1-9][0-9]{0,2}([.][0-9]{3})+$")
    plain = (
        F.when(comma & point, F.when(last_comma, as_comma).otherwise(as_point))
        .when(comma, F.when(grouped_comma & (mark == "."), as_point).otherwise(as_comma))
        .when(point, F.when(grouped_point & (mark == ","), as_comma).otherwise(as_point))
        .otherwise(text)
    )
    return plain.try_cast("double")


def amounts(rows: DataFrame, text: str = "flowsheet_result_txt", unit: str = "flowsheet_unit_of_measure_txt", mark: str = "decimal_mark") -> DataFrame:
    """The rows whose text holds a single amount, with amount and unit (code; null where neither text nor unit column names one)."""
    s = "\x01"
    t = F.col("t")
    rows = fenced(rows, t=F.replace(F.lower(F.regexp_replace(F.col(text), r"^\s+|\s+$", "")), F.lit("h2o"), F.lit("hho")))
    read = lambda kind, pattern: F.concat(F.lit(f"{kind}{s}"), F.regexp_replace(t, pattern, f"$1{s}$2{s}$3"))
    parts = F.split(F.when(t.rlike(FEET), read("feet", FEET)).when(t.rlike(POUNDS), read("pounds", POUNDS)).when(t.rlike(SINGLE), read("single", SINGLE)), s)
    rows = fenced(rows, parts=parts).filter("parts is not null")
    rows = fenced(rows, **{name: F.get("parts", F.lit(i)) for i, name in enumerate(("kind", "lead", "first", "second"))})
    single = F.col("kind") == "single"
    said = F.when(single & (F.col("second") != ""), F.coalesce(unit_code(F.col("second")), unit_code(F.regexp_extract("second", r"^(\S+)", 1))))
    rows = fenced(rows, a=number(F.col("first"), F.col(mark)), b=F.when(~single, number(F.col("second"), F.col(mark))), said=said, column_unit=unit_code(F.col(unit)), bound=F.col("lead").rlike(BOUNDS))
    whole = F.when(F.col("kind") == "feet", F.col("a") * 12 + F.col("b")).when(F.col("kind") == "pounds", F.col("a") + F.col("b") / 16).when((F.col("second") == "") | F.col("said").isNotNull(), F.col("a"))
    named = F.when(F.col("kind") == "feet", "in").when(F.col("kind") == "pounds", "lb").when(F.col("second") == "", F.col("column_unit")).otherwise(F.col("said"))
    return fenced(rows, amount=F.when(~F.col("bound"), whole), unit=named).drop("t", "parts", "kind", "lead", "first", "second", "a", "b", "said", "column_unit", "bound").filter("amount is not null")


def conversions(variables: DataFrame, factors: DataFrame) -> DataFrame:
    """(flowsheet_row_name_dk, unit, pre_add, factor), one row each."""
    known = factors.withColumn("unit", F.coalesce(unit_code(F.col("unit_code")), F.col("unit_code"))).groupBy("variable_id", "unit").agg(F.min("pre_add").alias("pre_add"), F.min("factor").alias("factor"))
    return variables.select("variable_id", "flowsheet_row_name_dk").distinct().join(known, "variable_id").select("flowsheet_row_name_dk", "unit", "pre_add", "factor").dropDuplicates(["flowsheet_row_name_dk", "unit"])
