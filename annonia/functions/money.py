"""Prices, numbers and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import choose, number, plain_spaces, some, take, text

#: Dinars in one of the unit.
PER_UNIT = {"Millions": 10000, "Milliards": 10000000}


def _factor(unit: Column) -> Column:
    return choose([(unit == u, float(n)) for u, n in PER_UNIT.items()], F.lit(1.0))


def traitement_prix(value: Column, unit: Column, require_unit: bool = False) -> Column:
    """Amount in dinars; 0.0 where it can't be read (or, if asked, has no unit)."""
    amount = F.coalesce(number(value.cast("string")) * _factor(text(unit)), F.lit(0.0))
    return F.when(text(unit) == "", 0.0).otherwise(amount) if require_unit else amount


def parse_price(raw: Column, unit: Column | None = None) -> Column:
    """struct(display, value, decimal, unit) of a displayed price."""
    unit = F.lit(None).cast("string") if unit is None else unit
    value = F.replace(F.regexp_replace(text(raw), r"[^\d.,]", ""), F.lit(","), F.lit("."))
    low = F.lower(text(unit))
    factor = choose([(F.contains(low, F.lit("million")), 10000.0), (F.contains(low, F.lit("milliard")), 10000000.0)], F.lit(1.0))
    display = F.when(text(unit) == "", value).otherwise(F.concat_ws(" ", value, F.trim(unit)))
    empty = text(raw) == ""  # its value is empty and no number
    return F.struct(
        F.when(empty, "").otherwise(display).alias("display"),
        value.alias("value"),
        F.coalesce(number(value) * factor, F.lit(0.0)).alias("decimal"),
        F.when(empty | (text(unit) == ""), "DA").otherwise(unit).alias("unit"),
    )


def vehicle_price(value: Column, unit: Column) -> Column:
    """Unit-aware amount: in dinars only the digits count; elsewhere a comma is the decimal point."""
    clean = F.regexp_replace(plain_spaces(value), r"\s", "")
    read = number(F.replace(clean, F.lit(","), F.lit("."))) * _factor(text(unit))
    digits = number(F.regexp_replace(clean, r"[^0-9]", ""))
    return F.coalesce(F.when(text(unit).isin("DA", "DZD", ""), digits).otherwise(F.coalesce(read, digits)), F.lit(0.0))


def _without(col: Column, *parts: str) -> Column:
    out = text(col)
    for p in parts:
        out = F.replace(out, F.lit(p), F.lit(""))
    return out


def str_to_float(col: Column, electronics: bool = False) -> Column:
    """Number without thousands marks and currency; the electronics form knows neither DZD nor no-break spaces."""
    clean = _without(col, ",", "د.ج", "DA", " ") if electronics else _without(col, ",", "د.ج", "DA", "DZD", " ", "\u00a0")
    return F.coalesce(number(clean), F.lit(0.0))


def process_price(col: Column) -> Column:
    """Number with a decimal comma, without currency."""
    return F.coalesce(number(F.replace(_without(col, "DZD", "Da", "DA", " ", "\u00a0"), F.lit(","), F.lit("."))), F.lit(0.0))


def split_price_unit(col: Column) -> Column:
    """struct(amount, unit): a number of millions or milliards, else digits with dots as thousands marks."""
    clean = F.regexp_replace(F.replace(plain_spaces(col), F.lit("/M²"), F.lit("")), r"\s+", " ")
    unit = take(clean, r"(Millions|Milliards)")
    amount = take(clean, r"([\d.,]+)\s*(?:Millions|Milliards)")
    digits = F.regexp_replace(take(clean, r"(\d[\d. ]*)"), r"[^0-9]", "")
    return F.struct(
        F.coalesce(F.when(unit.isNotNull(), number(F.replace(amount, F.lit(","), F.lit(".")))).otherwise(number(digits)), F.lit(0.0)).alias("amount"),
        F.coalesce(unit, F.when(digits.isNotNull(), "DA"), F.lit("")).alias("unit"),
    )


def price_range_low(col: Column) -> Column:
    return F.trim(F.element_at(F.split(text(col), r" *- *"), 1))


def instalments(monthly: Column, months: Column, first: Column) -> Column:
    """struct(par_facilite, prix_facilite, premier_versement, total)."""
    amount, n = process_price(monthly), F.coalesce(take(months, r"(\d+)").try_cast("int"), F.lit(0))
    on = (amount > 0) & (n > 0)
    return F.struct(
        on.alias("par_facilite"),
        F.when(on, F.create_map(n.cast("string"), amount)).alias("prix_facilite"),
        process_price(first).alias("premier_versement"),
        F.when(on, amount * n).otherwise(0.0).alias("total"),
    )


_SUM = r"(\d[\d ]*)"
#: Monthly plans in text: sum and number of months; a sale by instalments names its months behind a stroke.
PLAN = rf"(?iu){_SUM}(?:DA|DZD)?\s*/\s*mois\s*(?:jusqu'à|pendant|sur)\s*(\d+)\s*mois"
BY_INSTALMENTS, MONTHS, FIRST_PAYMENT = rf"(?iu)vente par facilité\s*:\s*{_SUM}", r"(?iu)/\s*(\d+)\s*mois", rf"(?iu)premier versement\s*:?\s*{_SUM}"


def parse_instalments(col: Column) -> Column:
    """struct(par_facilite, prix_facilite, premier_versement, premier_versement_value, total) from text.

    ``prix_facilite`` maps the months of each plan to its monthly sum, of equal months the last. ``total`` is what the first
    plan comes to; a sale by instalments without months has its sum. Without any plan it is 0."""
    shown = plain_spaces(col)
    monthly, months = (F.regexp_extract_all(shown, F.lit(PLAN), F.lit(g)) for g in (1, 2))
    one, one_months = take(shown, BY_INSTALMENTS), take(F.regexp_extract(shown, r"(?iu)vente par facilité.*", 0), MONTHS)
    alone = F.when(one.isNotNull() & one_months.isNotNull(), F.array(F.struct(one_months.alias("months"), one.alias("sum"))))
    plans = F.coalesce(alone, F.zip_with(months, monthly, lambda m, s: F.struct(m.alias("months"), s.alias("sum"))))
    priced = F.transform(plans, lambda p: F.struct(p["months"].alias("label"), process_price(p["sum"]).alias("value")))
    lone = F.get(priced, F.lit(0))
    by_map = F.map_from_entries(F.filter(priced, lambda p, i: F.array_position(F.slice(F.transform(priced, lambda q: q["label"]), i + 2, F.greatest(F.size(priced), F.lit(1))), p["label"]) == 0))
    first = take(shown, FIRST_PAYMENT)
    return F.struct(
        (one.isNotNull() | (F.size(plans) > 0)).alias("par_facilite"),
        by_map.alias("prix_facilite"),
        first.isNotNull().alias("premier_versement"),
        process_price(first).alias("premier_versement_value"),
        F.coalesce(lone["value"] * lone["label"].try_cast("int"), process_price(one)).alias("total"),
    )


def discount(shown: Column, old: Column) -> Column:
    """struct(old_price, price): digits of the old price, and of what is left when its text is cut out."""
    rest = F.when(text(old) == "", text(shown)).otherwise(F.replace(text(shown), text(old), F.lit("")))
    return F.struct(F.regexp_replace(text(old), r"[^0-9]", "").alias("old_price"), F.regexp_replace(rest, r"[^0-9]", "").alias("price"))


def price_and_tax(net: Column, gross: Column) -> Column:
    """struct(price, tax): net 'HT', else gross 'TTC'."""
    return F.struct(
        F.coalesce(some(text(net)), some(text(gross)), F.lit("")).alias("price"),
        F.when(text(net) != "", "HT").when(text(gross) != "", "TTC").otherwise("").alias("tax"),
    )


def avec_sans_prix(value: Column, unit: Column) -> Column:
    given = (F.coalesce(number(value.cast("string")), F.lit(0.0)) != 0) & (text(unit) != "")
    return F.when(given, "Avec prix").otherwise("Sans prix")


def avec_sans_photo(images: Column) -> Column:
    """Takes an array; an empty one means no photo."""
    return F.when(F.size(F.filter(F.coalesce(images, F.array().cast("array<string>")), lambda x: text(x) != "")) > 0, "Avec photo").otherwise("Sans photo")


def parse_float_or_none(col: Column) -> Column:
    return number(col)


def str_to_int(col: Column) -> Column:
    return F.coalesce(F.regexp_replace(text(col), r"[^0-9]", "").try_cast("int"), F.lit(0))


def extract_salary(col: Column) -> Column:
    """struct(amount, unit) of the first amount in dinars."""
    amount = take(plain_spaces(col), r"(?i)(\d[\d\s]*)(?:DA|DZD|dinars?)")
    return F.struct(F.coalesce(F.regexp_replace(amount, r"\s", ""), F.lit("")).alias("amount"), F.when(amount.isNotNull(), "DA").otherwise("").alias("unit"))


def extract_salary_range(col: Column) -> Column:
    """struct(salary, unit, as_prix): 'a-b' of a range, else the one amount."""
    clean = plain_spaces(col)
    pattern = r"(?i)(\d[\d\s]*)-\s*(\d[\d\s]*)(?:DA|DZD|dinars?)"
    low, high = take(clean, pattern, 1), take(clean, pattern, 2)
    one = F.coalesce(take(clean, r"(?i)salaire\D*(\d[\d\s]*)(?:DA|DZD|dinars?)"), take(clean, r"(?i)(\d[\d\s]*)(?:DA|DZD|dinars?)"))
    found = F.coalesce(F.regexp_replace(F.concat(low, F.lit("-"), high), r"\s", ""), F.regexp_replace(one, r"\s", ""), F.lit(""))
    return F.struct(found.alias("salary"), F.when(found != "", "DA").otherwise("").alias("unit"), F.when(found != "", "Avec prix").otherwise("Sans prix").alias("as_prix"))


def normalize_mileage(col: Column) -> Column:
    """struct(km, unit): all digits joined."""
    return F.struct(F.regexp_replace(text(col), r"[^0-9]", "").alias("km"), F.when(F.contains(F.lower(text(col)), F.lit("mi")), "Miles").otherwise("KM").alias("unit"))


def normalize_km(col: Column) -> Column:
    return str_to_int(col)


def normalize_year(col: Column) -> Column:
    return F.coalesce(take(col, r"\b((?:19|20)\d{2})\b").try_cast("int"), F.lit(0))


def extract_engine_size(col: Column, strict: bool = False) -> Column:
    """Litres: 'x L', else cubic centimetres, else (unless strict) a decimal from 0.5 to 8."""
    low = F.replace(F.lower(text(col)), F.lit(","), F.lit("."))
    litres = number(take(low, r"(\d+(?:\.\d+)?)\s*l\b"))
    cc = number(take(low, r"(\d{3,5})\s*(?:cc|cm³|cm3)")) / 1000
    bare = number(take(low, r"\b(\d\.\d)\b"))
    return F.coalesce(litres, cc, *([] if strict else [F.when(bare.between(0.5, 8.0), bare)]), F.lit(0.0))


def normalize_pieces(col: Column) -> Column:
    return take(col, r"(\d+)").try_cast("int")


def extract_superficie(col: Column) -> Column:
    """struct(value, unit) of the first area in square metres."""
    value = number(F.replace(take(plain_spaces(col), r"(?iu)(\d+(?:[.,]\d+)?)\s*m(?:²|2)"), F.lit(","), F.lit(".")))
    return F.struct(value.alias("value"), F.when(value.isNotNull(), "m²").otherwise("").alias("unit"))


def extract_rooms_number(col: Column) -> Column:
    return F.coalesce(take(col, r"(?i)\bF(\d+)"), F.lit(""))


def extract_etage_number(col: Column) -> Column:
    """'R+2' has three floors; else the number before 'étages'."""
    plus = take(col, r"(?i)\b(?:RDC|R)\s*\+\s*(\d+)").try_cast("int") + 1
    return F.coalesce(plus.cast("string"), take(col, r"(?iu)(\d+)\s*étages?"), F.lit(""))


def export_flag(unit: Column) -> Column:
    return F.when(text(unit).isin("DA", "DZD", "Millions", "Milliards", ""), "false").otherwise("true")


def split_value_unit(col: Column) -> Column:
    """struct(value, unit): first and last token."""
    tokens = F.split(F.trim(F.regexp_replace(plain_spaces(col), r"\s+", " ")), " ")
    return F.struct(F.element_at(tokens, 1).alias("value"), F.when(F.size(tokens) > 1, F.element_at(tokens, -1)).otherwise("").alias("unit"))


def engine_figures(col: Column) -> Column:
    """struct(litres, power): all litre and horse-power figures."""
    return F.struct(
        F.regexp_extract_all(text(col), F.lit(r"(?i)(\d+(?:\.\d+)?)\s*L\b"), F.lit(1)).alias("litres"),
        F.regexp_extract_all(text(col), F.lit(r"(?i)(\d+)\s*(?:HP|CV|ch)\b"), F.lit(1)).alias("power"),
    )


def horse_power(col: Column) -> Column:
    """'120HP' -> '120 CV'."""
    return F.coalesce(F.concat(take(col, r"(?i)(\d+)\s*HP\b"), F.lit(" CV")), F.lit(""))


