"""Technical figures in free text. Missing ones are ''.

A figure is a number with a unit. The vocabularies below name the labels and units of each; ``_figure``
makes the rules from them: first a labelled figure, then one with certain words behind it, then any."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import choose, take, take_any, text

# ---- fixed values ----
COLORS = {
    "blanc": "Blanc", "white": "Blanc", "noir": "Noir", "black": "Noir", "gris": "Gris", "gray": "Gris", "grey": "Gris", "silver": "Silver", "argent": "Silver",
    "inox": "Inox", "stainless": "Inox", "rouge": "Rouge", "red": "Rouge", "bleu": "Bleu", "blue": "Bleu",
}
# labels
CAPACITY = ["capacité", "capacity"]
POWER = ["puissance", "power"]
WEIGHT = ["poids", "weight"]
MEMORY = ["ram"]
STORAGE = ["storage", "stockage"]
SCREEN = ["taille de l'écran", "taille écran"]
WARRANTY = ["garantie", "warranty"]
PROCESSOR = ["cpu", "processor"]
REAR_CAMERA = ["caméra arrière", "rear camera", "arrière"]
FRONT_CAMERA = ["caméra avant", "front camera", "avant", "selfie"]
# units
VOLUMES = ["litres", "litre", "l", "kg"]
WATTS = ["watts", "watt", "w", "kw"]
MASSES = ["kg", "g"]
BYTES = ["gb", "go"]
DISK_BYTES = ["gb", "tb"]
INCHES = ["inch", "pouces", "\"", "″"]
YEARS = ["years", "year", "ans", "سنة"]
MONTHS = ["months", "month", "mois"]
PIXELS = ["mégapixels", "mp"]
CHARGES = ["mah"]
# other words
DISK_KINDS = ["m.2", "nvme", "ssd"]
MEMORY_KINDS = ["ram", "ddr"]
VERSIONED_SYSTEMS = ["Windows", "macOS", "iOS", "Android"]
OTHER_SYSTEMS = ["Linux", "Ubuntu", "Chrome OS"]
PANELS = ["QLED", "OLED", "AMOLED", "LED", "LCD", "IPS", "Retina"]
CPU_FAMILIES = ["intel i", "intel core i", "ryzen", "core ultra"]
CORE_COUNTS = ["quad-core", "octa-core"]
# ---- end of fixed values ----

NUMBER = r"\d+(?:\.\d+)?"


def _words(words: list[str]) -> str:
    """Any of the words, the longest first, with blanks of any kind between their parts."""
    parts = sorted(words, key=lambda w: (-len(w), w))
    return "(?:" + "|".join(r"\s*".join(p.replace(".", r"\.") for p in w.split(" ")) for w in parts) + ")"


def _figure(col: Column, units: list[str], labels: list[str] = (), behind: list[str] = (), between: list[str] = (), bare: bool = True, unit_needed: bool = True) -> Column:
    """struct(value, unit) as written. Labels may be followed by ``between`` words, a bracket and a colon."""
    amount = rf"{NUMBER}\s*{_words(units)}" + ("" if unit_needed else "?")
    gap = r"\s*" + (rf"(?:{_words(between)}\s*)*" if between else "")
    shapes = []
    if labels:
        shapes.append(rf"{_words(labels)}{gap}(?:\([^)]*\)\s*)?:?{gap}{amount}")
    if behind:
        shapes.append(rf"{amount}\s*(?={_words(behind)})")
    if bare:
        shapes.append(amount)
    found = F.coalesce(*(take(col, "(?iu)" + s, 0) for s in shapes))
    ending = rf"(?iu)({NUMBER})\s*({_words(units)}?)\s*$"  # a label's own digits come before
    return F.struct(
        F.coalesce(F.regexp_extract(found, ending, 1), F.lit("")).alias("value"),
        F.coalesce(F.regexp_extract(found, ending, 2), F.lit("")).alias("unit"),
    )


def _with_unit(figure: Column, unit: Column) -> Column:
    return F.struct(figure["value"].alias("value"), F.when(figure["value"] != "", unit).otherwise("").alias("unit"))


def extract_capacity(col: Column) -> Column:
    found = _figure(col, VOLUMES, CAPACITY)
    return _with_unit(found, F.when(F.lower(found["unit"]) == "kg", "kg").otherwise("L"))


def extract_energy_class(col: Column) -> Column:
    """'A+++' to 'G', in capitals only; plus signs may end the text."""
    return take_any(col, [r"(?<![\w])(A\+{1,3}|[A-G](?![\w+]))"])


def extract_power(col: Column) -> Column:
    found = _figure(col, WATTS, POWER)
    return _with_unit(found, F.when(F.lower(found["unit"]) == "kw", "KW").otherwise("W"))


def extract_dimensions(col: Column, bare: bool = False) -> Column:
    """'a x b x c cm'; ``bare`` also takes three figures of 2-4 digits without unit or label."""

    def box(side: str, before: str = "", after: str = "") -> Column:
        return take(col, "(?i)" + before + r"\s*[x×]\s*".join([side] * 3) + after, 0)

    sides = [box(r"\d{1,3}(?:\.\d+)?", after=r"\s*cm"), box(r"\d{1,3}", before=r"dimensions?\s*:?\s*")]
    found = F.coalesce(*sides, *([box(r"\d{2,4}")] if bare else []))
    figures = F.regexp_extract_all(found, F.lit(NUMBER), F.lit(0))
    return F.when(found.isNull(), "").otherwise(F.concat(F.array_join(figures, " x "), F.lit(" cm")))


def extract_weight(col: Column) -> Column:
    labelled, any_kg = _figure(col, MASSES, WEIGHT, bare=False), _figure(col, MASSES[:1])
    found = F.when(labelled["value"] != "", labelled).otherwise(any_kg)
    return _with_unit(found, F.lower(found["unit"]))


def extract_color(col: Column) -> Column:
    low = F.lower(text(col))
    return choose([(F.contains(low, F.lit(word)), name) for word, name in COLORS.items()], F.lit(""))


def extract_warranty(col: Column) -> Column:
    """struct(value, unit): years unless months are named."""
    found = _figure(col, MONTHS + YEARS, WARRANTY, bare=False, unit_needed=False)
    return _with_unit(found, F.when(F.lower(found["unit"]).isin(MONTHS), "mois").otherwise("ans"))


def extract_ram(col: Column) -> Column:
    return _with_unit(_figure(col, BYTES, MEMORY, behind=MEMORY_KINDS, bare=False), F.lit("GB"))


def extract_storage(col: Column) -> Column:
    found, by_capacity = _figure(col, DISK_BYTES, STORAGE, DISK_KINDS, DISK_KINDS, bare=False), _figure(col, DISK_BYTES, CAPACITY, bare=False)
    return F.when(found["value"] != "", found).otherwise(by_capacity)


def extract_processor(col: Column) -> Column:
    """What stands behind the label up to a bracket, with the speed in it if given (without a speed, label and all); else a known family with its number; else the number of cores."""
    labelled = take(col, rf"(?iu){_words(PROCESSOR)}\s*:?[^()]+(?:\(\s*{NUMBER}\s*GHz\s*\))?", 0)
    speed = take(labelled, rf"(?i)\(\s*({NUMBER}\s*GHz)\s*\)")
    name = F.trim(F.regexp_replace(F.regexp_replace(labelled, r"\([^)]*\)$", ""), rf"(?iu)^{_words(PROCESSOR)}\s*:?", ""))
    family = take(col, rf"(?iu)\b{_words(CPU_FAMILIES)}\s*\d(?:[\s-]*\d{{3,5}}[a-z]{{0,2}})?", 0)
    return F.coalesce(F.when(speed.isNotNull(), F.concat(name, F.lit(" ("), speed, F.lit(")"))), F.trim(labelled), family, take(col, rf"(?i){_words(CORE_COUNTS)}", 0), F.lit(""))


def extract_screen_size(col: Column) -> Column:
    """Inches; a labelled size needs no unit."""
    labelled = _figure(col, INCHES, SCREEN, bare=False, unit_needed=False)["value"]
    return F.when(labelled != "", labelled).otherwise(_figure(col, INCHES)["value"])


def extract_os(col: Column) -> Column:
    """struct(name, version); the first system in the order of the lists."""

    def version(name: str) -> Column:
        return take(col, rf"(?i){_words([name])}\s*(\d{{1,2}}(?:\.\d+)?)")

    def named(name: str, v: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), v.alias("version"))

    with_version = [F.when(version(name).isNotNull(), named(name, version(name))) for name in VERSIONED_SYSTEMS]
    without = [F.when(text(col).rlike("(?i)" + _words([name])), named(name, F.lit(""))) for name in OTHER_SYSTEMS]
    return F.coalesce(*with_version, *without, named("", F.lit("")))


def extract_camera(col: Column) -> Column:
    """struct(rear, front) in megapixels."""
    rear, front = (_figure(col, PIXELS, labels, bare=False)["value"] for labels in (REAR_CAMERA, FRONT_CAMERA))
    return F.struct(rear.alias("rear"), front.alias("front"))


def extract_battery(col: Column) -> Column:
    return _figure(col, CHARGES)["value"]


def screen_type(col: Column) -> Column:
    return F.upper(take_any(col, [r"(?i)\b(" + "|".join(PANELS) + r")\b"]))


def specs_from_lines(lines: Column, whole: Column) -> Column:
    """struct of processor, ram, storage, warranty, color, weight, os: from the lines, else from the whole text."""
    cpus = F.filter(F.transform(lines, extract_processor), lambda x: x != "")

    def fill(fn, field="value"):
        found = F.filter(F.transform(lines, lambda x: fn(x)[field]), lambda x: x != "")
        return F.coalesce(F.try_element_at(found, F.lit(1)), fn(whole)[field])

    return F.struct(
        F.when(F.size(cpus) > 0, F.array_join(cpus, ", ")).otherwise(extract_processor(whole)).alias("processor"),
        fill(extract_ram).alias("ram"), fill(extract_storage).alias("storage"), fill(extract_warranty).alias("warranty"),
        extract_color(whole).alias("color"), extract_weight(whole)["value"].alias("weight"), extract_os(whole)["name"].alias("os"),
    )


def specs_table_override(specs: Column, key: str, from_text: Column, override: bool = True) -> Column:
    """A spec-table value before the one from text, or only where the text has none."""
    table = F.when(F.trim(F.try_element_at(specs, F.lit(key))) != "", F.trim(F.try_element_at(specs, F.lit(key))))
    found = F.when(text(from_text) != "", from_text)
    return F.coalesce(*((table, found) if override else (found, table)), F.lit(""))
