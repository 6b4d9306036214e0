"""Queries of the listing jobs over the given tables, with their SQL.

``_columns`` queries apply column functions to a composed input, one column an operator, beside the
SQL expression that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, money, pages, specs, vocab
from ..operators import frontier, metrics, rows, upsert
from ..sources import html, io
from . import jobs
from .compose import cte, frame

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
AS_OF = "2026-01-15"
C = F.col


def _as_of() -> Column:
    return F.to_date(F.lit(AS_OF))


def query(sql: str | None, *inputs: str):
    """Register a query; ``sql`` reads the composed inputs by name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = (cte(*inputs) if inputs else "") + sql
        return f

    return add


def _columns(name: str, source: str, key: str, cols: dict[str, tuple[Callable[[], Column], str]]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return frame(spark, sf_dir, source, wide=True).select(key, *(make().alias(n) for n, (make, _) in cols.items()))

    QUERIES[name] = run
    ORACLE[name] = cte(source) + f"SELECT {key}, " + ", ".join(f"{sql} AS {n}" for n, (_, sql) in cols.items()) + f" FROM {source}"


# ---- SQL fragments for DuckDB ----
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(x: str, table: dict[str, str], other: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items()) + f" ELSE {other} END"


def _has(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {_q(w)})" for w in words) + ")"


def _first(x: str, rules: list[tuple[list[str], str]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {_has(x, words)} THEN {_q(v)}" for words, v in rules) + f" ELSE {other} END"


#: What counts as a number in text, for the SQL.
NUMERIC = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def _num(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {_q(NUMERIC)}) THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def _rx(x: str, pattern: str, group: int = 1, flags: str = "") -> str:
    return f"NULLIF(regexp_extract({x}, {_q(pattern)}, {group}{', ' + _q(flags) if flags else ''}), '')"


_FACTOR = "(CASE prix_unit WHEN 'Millions' THEN 10000.0 WHEN 'Milliards' THEN 10000000.0 ELSE 1.0 END)"
_VALUE = "replace(regexp_replace(prix_text, '[^0-9.,]', '', 'g'), ',', '.')"
_DIGITS = "regexp_replace(prix_text, '[^0-9]', '', 'g')"
_SPACELESS = "regexp_replace(prix_text, '\\s', '', 'g')"
_MULT = "(CASE WHEN contains(lower(prix_unit), 'million') THEN 10000.0 WHEN contains(lower(prix_unit), 'milliard') THEN 10000000.0 ELSE 1.0 END)"
_DECIMAL = f"(CASE WHEN prix_text = '' THEN 0.0 ELSE coalesce(({_num(_VALUE)}) * {_MULT}, 0.0) END)"

# D1-D7, D11, D13, D23, D24
_columns(
    "prices",
    "listings_raw",
    "row_id",
    {
        "traitement": (lambda: money.traitement_prix(money.parse_price(C("prix_text"))["value"], C("prix_unit")), f"coalesce(({_num(_VALUE)}) * {_FACTOR}, 0.0)"),
        "traitement_shop": (lambda: money.traitement_prix(money.parse_price(C("prix_text"))["value"], C("prix_unit"), True), f"CASE WHEN prix_unit = '' THEN 0.0 ELSE coalesce(({_num(_VALUE)}) * {_FACTOR}, 0.0) END"),
        "parsed": (lambda: money.parse_price(C("prix_text"), C("prix_unit"))["decimal"], _DECIMAL),
        "display": (lambda: money.parse_price(C("prix_text"), C("prix_unit"))["display"], f"CASE WHEN prix_text = '' THEN '' WHEN prix_unit = '' THEN {_VALUE} ELSE concat({_VALUE}, ' ', prix_unit) END"),
        "unit": (lambda: money.parse_price(C("prix_text"), C("prix_unit"))["unit"], "CASE WHEN prix_text = '' OR prix_unit = '' THEN 'DA' ELSE prix_unit END"),
        "vehicle": (
            lambda: money.vehicle_price(C("prix_text"), C("prix_unit")),
            f"coalesce(CASE WHEN prix_unit IN ('DA','DZD','') THEN {_num(_DIGITS)} ELSE coalesce(({_num(f'replace({_SPACELESS}, {_q(",")}, {_q(".")})')}) * {_FACTOR}, {_num(_DIGITS)}) END, 0.0)",
        ),
        "plain": (lambda: money.str_to_float(C("prix_text")), f"coalesce({_num("replace(replace(replace(replace(prix_text, ',', ''), 'DA', ''), 'DZD', ''), ' ', '')")}, 0.0)"),
        "plain_electronics": (lambda: money.str_to_float(C("prix_text"), True), f"coalesce({_num("replace(replace(replace(prix_text, ',', ''), 'DA', ''), ' ', '')")}, 0.0)"),
        "processed": (lambda: money.process_price(C("prix_text")), f"coalesce({_num("replace(replace(replace(replace(replace(prix_text, 'DZD', ''), 'Da', ''), 'DA', ''), ' ', ''), ',', '.')")}, 0.0)"),
        "split_amount": (
            lambda: money.split_price_unit(C("prix_text"))["amount"],
            f"coalesce(CASE WHEN {_rx('prix_text', '(Millions|Milliards)')} IS NOT NULL THEN TRY_CAST(replace(regexp_extract(prix_text, '([\\d.,]+)\\s*(?:Millions|Milliards)', 1), ',', '.') AS DOUBLE) ELSE TRY_CAST(regexp_replace(regexp_extract(prix_text, '(\\d[\\d. ]*)', 1), '[^0-9]', '', 'g') AS DOUBLE) END, 0.0)",
        ),
        "low": (lambda: money.price_range_low(C("prix_text")), "trim(split_part(prix_text, '-', 1))"),
        "as_prix": (lambda: money.avec_sans_prix(money.parse_price(C("prix_text"), C("prix_unit"))["decimal"], C("prix_unit")), f"CASE WHEN {_DECIMAL} <> 0 AND prix_unit <> '' THEN 'Avec prix' ELSE 'Sans prix' END"),
        "float_or_none": (lambda: money.parse_float_or_none(C("prix_text")), _num("prix_text")),
        "whole": (lambda: money.str_to_int(C("prix_text")), f"coalesce(TRY_CAST({_DIGITS} AS INTEGER), 0)"),
        "export": (lambda: money.export_flag(C("prix_unit")), "CASE WHEN prix_unit IN ('DA','DZD','Millions','Milliards','') THEN 'false' ELSE 'true' END"),
        "first_token": (lambda: money.split_value_unit(C("prix_text"))["value"], "split_part(trim(prix_text), ' ', 1)"),
    },
)

_FUEL_WORDS = "CASE WHEN contains(lower(energie_text), 'essence') AND contains(lower(energie_text), 'gpl') THEN 'GPL' WHEN contains(lower(energie_text), 'hybrid') THEN 'Hybride' WHEN contains(lower(energie_text), 'electrique') OR contains(lower(energie_text), 'electric') THEN 'Electrique' WHEN contains(lower(energie_text), 'diesel') THEN 'Diesel' WHEN contains(lower(energie_text), 'essence') OR contains(lower(energie_text), 'gasoline') OR contains(lower(energie_text), 'petrol') THEN 'Essence' ELSE 'Multi-énergie' END"
_FUEL = f"(CASE WHEN energie_text = '' THEN '' ELSE {_case('trim(energie_text)', vocab.FUEL, _FUEL_WORDS)} END)"
# E1, E2, H1, H2, H9, B7, B8, A11, I9, I10
_columns(
    "fuel_and_keys",
    "listings_raw",
    "row_id",
    {
        "fuel": (lambda: vocab.normalize_fuel(C("energie_text")), _FUEL),
        "fuel_exact": (lambda: vocab.normalize_energie_exact(C("energie_text")), f"CASE WHEN energie_text = '' THEN '' ELSE {_case('trim(energie_text)', vocab.FUEL, _q('Multi-énergie'))} END"),
        "parsed_date": (lambda: dates.parse_date(C("date_text")), "coalesce(strftime(coalesce(TRY_STRPTIME(date_text, '%d/%m/%Y %H:%M:%S'), TRY_STRPTIME(date_text, '%d/%m/%Y'), TRY_STRPTIME(date_text, '%Y-%m-%d')), '%Y-%m-%dT%H:%M:%S'), '')"),
        "date_or_input": (lambda: dates.parse_date_or_input(C("date_text")), "coalesce(strftime(TRY_STRPTIME(date_text, '%d/%m/%Y %H:%M:%S'), '%Y-%m-%dT%H:%M:%S'), date_text)"),
        "display_date": (lambda: dates.format_display_date(C("date_text")), "coalesce(strftime(TRY_STRPTIME(date_text, '%Y-%m-%d'), '%d/%m/%Y %H:%M:%S'), date_text)"),
        "listing_id": (lambda: pages.listing_id_from_url(C("url")), _rx("url", "d(\\d+)$")),
        "numero": (lambda: pages.numero_from_url(C("url"), "last_dash"), "regexp_extract(url, '-([^-/?#]+)/?$', 1)"),
        "stem": (lambda: pages.doc_file_stem(C("url"), F.lit(None).cast("string"), C("energie_text")), "substr(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[^0-9A-Za-z_-]', '', 'g'), 1, 64)"),
        "doc_id": (lambda: rows.doc_id(C("url"), C("site"), C("category")), "url"),
        "version": (lambda: rows.version_id(C("url"), C("site")), "concat(url, '|', site)"),
        "composite": (lambda: rows.composite_numero(F.lit(""), C("category"), C("energie_text"), C("prix_unit")), "replace(concat(category, '_', energie_text, '_', prix_unit), ' ', '_')"),
    },
)

_LOW_TITLE = "lower(titre)"
_TRANSACTION = _first(_LOW_TITLE, [(["location vacance"], "Location-vacances"), (["cherche location", "recherche location", "je cherche à louer"], "Cherche-location"), (["cherche achat", "recherche achat", "cherche à acheter"], "Cherche-achat"), (["location", "louer"], "Location"), (["vente", "vendre"], "Vente")], "''")
_BIEN = _case("lower(trim(bien_text))", {t.lower(): t for t in vocab.PROPERTY_TYPES} | vocab.PROPERTY_ALIASES, _first("lower(trim(bien_text))", [([a], v) for a, v in vocab.PROPERTY_ALIASES.items()] + [([t.lower()], t) for t in sorted(vocab.PROPERTY_TYPES, key=lambda t: (-len(t), t))], "''"))
# E3-E6, E8, E12-E15, E25, E7
_columns(
    "vocabularies",
    "words",
    "row_id",
    {
        "bien": (lambda: vocab.convert_property_type(C("bien_text")), _BIEN),
        "transaction": (lambda: vocab.detect_transaction(C("titre")), _TRANSACTION),
        "boite_norm": (
            lambda: vocab.normalize_transmission(C("boite")),
            "CASE WHEN boite = '' THEN '' WHEN upper(trim(boite)) IN ('AT','DCT','CVT','E-CVT','DHT','AMT','TCT','E-CVT+AT','ISR') THEN 'Automatique' WHEN contains(upper(boite), 'SEMI') THEN 'Semi-Automatique' WHEN contains(upper(boite), 'AUTOMATI') THEN 'Automatique' WHEN upper(trim(boite)) = 'MT' OR contains(upper(boite), 'MANUEL') THEN 'Manuelle' ELSE trim(boite) END",
        ),
        "diplome_norm": (lambda: vocab.normalize_diplome(C("diplome")), f"CASE WHEN lower(diplome) IN ('', 'non diplômante', 'sans diplôme', 'sans diplome', 'pas important') THEN NULL ELSE {_case('lower(diplome)', vocab.DIPLOMAS, 'diplome')} END"),
        "domaine_norm": (lambda: vocab.normalize_domaine(C("domaine")), _case("trim(domaine)", vocab.DOMAINS, "'Autre'")),
        "domaine_2": (lambda: vocab.normalize_domaine_2(C("domaine")), _case("trim(domaine)", vocab.DOMAINS_2, "trim(domaine)")),
        "wilaya": (lambda: vocab.extract_wilaya(C("adresse")), "CASE WHEN lower(adresse) IN ('', 'télétravail') THEN 'Télétravail' ELSE trim(split_part(adresse, ',', 1)) END"),
        "region": (lambda: vocab.split_wilaya_commune(C("adresse"))["wilaya"], "trim(CASE WHEN contains(adresse, ' - ') THEN split_part(adresse, ' - ', 1) ELSE split_part(adresse, '-', 1) END)"),
        "commune": (lambda: vocab.split_wilaya_commune(C("adresse"))["commune"], "trim(CASE WHEN contains(adresse, ' - ') THEN split_part(adresse, ' - ', 2) ELSE split_part(adresse, '-', 2) END)"),
        "city": (lambda: vocab.wilaya_from_city(C("adresse")), f"CASE WHEN adresse = '' THEN 'N/A' ELSE {_case('lower(trim(adresse))', vocab.CITIES, "CASE adresse WHEN 'Alger, Hydra' THEN 'Alger, Hydra' WHEN 'Blida - Centre' THEN 'Blida - Centre' ELSE 'Setif-ville' END")} END"),
        "contrat": (lambda: vocab.normalize_contrat(C("boite")), f"CASE WHEN boite = '' THEN 'Non specifie' ELSE {_case('lower(trim(boite))', vocab.CONTRACTS, 'boite')} END"),
        "experience": (lambda: vocab.normalize_experience_2(C("titre")), f"CASE WHEN titre = '' THEN 'Non specifie' ELSE {_case('lower(trim(titre))', vocab.EXPERIENCE_B, 'titre')} END"),
        "experience_a": (lambda: vocab.normalize_experience(C("titre")), _case("trim(titre)", vocab.EXPERIENCE_A, "trim(titre)")),
        "title_domain": (lambda: vocab.domain_from_title(C("titre")), _first(_LOW_TITLE, [(w, n) for n, w in vocab.TITLE_DOMAINS], "'Autre'")),
        "status": (lambda: vocab.suspicious_status(C("titre")), "200"),
        "head": (lambda: vocab.job_title_head(C("adresse")), "trim(split_part(adresse, ' - ', 1))"),
        "vehicle": (lambda: vocab.vehicle_flag(F.when(C("k") % 2 == 0, "Oui"), C("titre")), "CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END"),
        "etat": (lambda: vocab.etat_from_context(C("km_text"), C("titre"), C("bien_text")), "CASE WHEN km_text IN ('', '0') THEN 'Neuf' ELSE 'Occasion' END"),
        "delivery": (lambda: vocab.delivery_text(C("bien_text")), "coalesce(NULLIF(trim(regexp_replace(bien_text, '[()\\[\\]]', '', 'g')), ''), '48 Wilayas')"),
        "brand_word": (lambda: vocab.brand_model_from_title(C("moteur_text"))["brand"], "split_part(moteur_text, ' ', 1)"),
        "model_words": (lambda: vocab.brand_model_from_title(C("moteur_text"))["model"], "concat(split_part(moteur_text, ' ', 2), ' ', split_part(moteur_text, ' ', 3))"),
        "after_brand": (lambda: vocab.model_after_brand(C("moteur_text"), F.lit("tsi")), "split_part(moteur_text, ' ', 3)"),
    },
)

# D14, D16-D22
_columns(
    "numbers",
    "words",
    "row_id",
    {
        "km": (lambda: money.normalize_mileage(C("km_text"))["km"], "regexp_replace(km_text, '[^0-9]', '', 'g')"),
        "km_unit": (lambda: money.normalize_mileage(C("km_text"))["unit"], "CASE WHEN contains(lower(km_text), 'mi') THEN 'Miles' ELSE 'KM' END"),
        "km_int": (lambda: money.normalize_km(C("km_text")), "CAST(regexp_replace(km_text, '[^0-9]', '', 'g') AS INTEGER)"),
        "annee": (lambda: money.normalize_year(C("moteur_text")), "CAST(regexp_extract(moteur_text, '\\b((?:19|20)\\d{2})\\b', 1) AS INTEGER)"),
        "litres": (lambda: money.extract_engine_size(C("moteur_text")), "CAST(regexp_extract(moteur_text, '\\b(\\d\\.\\d)\\b', 1) AS DOUBLE)"),
        "litres_strict": (lambda: money.extract_engine_size(C("moteur_text"), True), "CAST(0 AS DOUBLE)"),
        "rooms": (lambda: money.extract_rooms_number(C("lot_text")), "regexp_extract(lot_text, 'F(\\d+)', 1)"),
        "pieces": (lambda: money.normalize_pieces(C("lot_text")), "CAST(regexp_extract(lot_text, '(\\d+)', 1) AS INTEGER)"),
        "area": (lambda: money.extract_superficie(C("lot_text"))["value"], "CAST(regexp_extract(lot_text, '(\\d+(?:[.,]\\d+)?)\\s*m2', 1) AS DOUBLE)"),
        "floor": (lambda: money.extract_etage_number(C("lot_text")), "CAST(CAST(regexp_extract(lot_text, 'R\\+(\\d+)', 1) AS INTEGER) + 1 AS STRING)"),
        "salary": (lambda: money.extract_salary(C("salaire_text"))["amount"], "regexp_replace(regexp_extract(salaire_text, '(\\d[\\d\\s]*)DA', 1), '\\s', '', 'g')"),
        "salary_range": (lambda: money.extract_salary_range(C("salaire_text"))["salary"], "regexp_replace(regexp_extract(salaire_text, '(\\d[\\d\\s]*)DA', 1), '\\s', '', 'g')"),
    },
)

_AGO = "CAST(regexp_extract(quand, '(\\d+)', 1) AS INTEGER) * (CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 7 WHEN 2 THEN 30 ELSE 365 END)"
# H3-H8, H10
_columns(
    "relative_dates",
    "words",
    "row_id",
    {
        "normalized": (lambda: dates.normalize_date(C("quand"), _as_of()), f"strftime(DATE '{AS_OF}' - {_AGO}, '%Y-%m-%d')"),
        "relative": (lambda: dates.relative_date(C("quand"), _as_of()), f"strftime(DATE '{AS_OF}' - {_AGO}, '%Y-%m-%d')"),
        "iso": (lambda: dates.normalize_date(F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss"), _as_of()), "strftime(d, '%Y-%m-%d')"),
        "french": (lambda: dates.french_day_month(F.date_format("d", "dd.MM.yyyy"), _as_of()), "strftime(d, '%Y-%m-%d')"),
        "english": (lambda: dates.month_name_date(F.concat(F.date_format("d", "d"), F.lit(" Août "), F.date_format("d", "yyyy"), F.lit("10:20")), _as_of()), "CASE WHEN make_date(CAST(year(d) AS INTEGER), 8, CAST(day(d) AS INTEGER)) <= DATE '" + AS_OF + "' THEN strftime(make_date(CAST(year(d) AS INTEGER), 8, CAST(day(d) AS INTEGER)), '%Y-%m-%d') ELSE strftime(make_date(CAST(year(d) - 1 AS INTEGER), 8, CAST(day(d) AS INTEGER)), '%Y-%m-%d') END"),
        "updated": (lambda: dates.updated_on_date(F.concat(F.lit("Mis à jour le mars "), F.date_format("d", "d"), F.lit(", "), F.date_format("d", "yyyy"), F.lit(" : 4:05 PM"))), "strftime(make_date(CAST(year(d) AS INTEGER), 3, CAST(day(d) AS INTEGER)), '%Y-%m-%d')"),
        "glued": (lambda: dates.glued_date(F.concat(F.date_format("d", "d"), F.lit(" Jan "), F.date_format("d", "yyyy"), F.lit("11:02")), _as_of()), "strftime(make_date(CAST(year(d) AS INTEGER), 1, CAST(day(d) AS INTEGER)), '%Y-%m-%d')"),
        "or_now": (lambda: dates.dmy_or_now(F.when(C("k") % 2 == 0, F.date_format("d", "dd-MM-yyyy")), _as_of()), f"CASE WHEN k % 2 = 0 THEN CAST(d AS DATE) ELSE DATE '{AS_OF}' END"),
    },
)


def _rxi(pattern: str, group: int = 1) -> str:
    return f"coalesce({_rx('txt', pattern, group, 'i')}, '')"


_BRAND = lambda brands: f"coalesce(upper({_rx('txt', '^(' + '|'.join(brands) + ')\\b', 1, 'i')}), {_first('upper(txt)', [([b], b) for b in brands], "''")})"
# E18-E22, G1-G14, G17
_columns(
    "specs",
    "spec_text",
    "row_id",
    {
        "appliance": (lambda: vocab.normalize_categorie_appliance(F.when(C("row_id") % 4 == 1, "Grand FRIGO").otherwise("micro onde")), "CASE WHEN row_id % 4 = 1 THEN 'Réfrigérateurs & Congélateurs' ELSE 'Micro-ondes' END"),
        "electronics": (lambda: vocab.normalize_categorie_electronics(C("txt")), _first("lower(txt)", [(w, n) for n, w in vocab.ELECTRONICS], "txt")),
        "brand": (lambda: vocab.extract_brand(C("txt"), vocab.APPLIANCE_BRANDS), _BRAND(vocab.APPLIANCE_BRANDS)),
        "brand_2": (lambda: vocab.extract_brand(C("txt"), vocab.ELECTRONICS_BRANDS), _BRAND(vocab.ELECTRONICS_BRANDS)),
        "etat": (lambda: vocab.normalize_etat(C("txt"), F.lit("")), f"CASE WHEN {_has('lower(txt)', vocab.USED_WORDS['appliance'][0])} THEN 'Occasion' ELSE 'Neuf' END"),
        "power": (lambda: specs.extract_power(C("txt"))["value"], f"coalesce({_rx('txt', 'Puissance\\s*:?\\s*(\\d+(?:\\.\\d+)?)\\s*W', 1, 'i')}, {_rx('txt', '(\\d+(?:\\.\\d+)?)\\s*(?:W|KW)', 1, 'i')}, '')"),
        "dimensions": (lambda: specs.extract_dimensions(C("txt")), "CASE WHEN contains(txt, '60 x 55 x 85 cm') THEN '60 x 55 x 85 cm' ELSE '' END"),
        "weight": (lambda: specs.extract_weight(C("txt"))["value"], _rxi("([\\d.]+)\\s*(kg)\\b")),
        "color": (lambda: specs.extract_color(C("txt")), _first("lower(txt)", [([w], n) for w, n in specs.COLORS.items()], "''")),
        "warranty": (lambda: specs.extract_warranty(C("txt"))["value"], _rxi("Garantie\\s*:?\\s*(\\d+)")),
        "warranty_unit": (lambda: specs.extract_warranty(C("txt"))["unit"], "CASE WHEN contains(txt, ' Mois ') THEN 'mois' ELSE 'ans' END"),
        "ram": (lambda: specs.extract_ram(C("txt"))["value"], _rxi("RAM\\s*:?\\s*(\\d+)\\s*(GO|GB)")),
        "storage": (lambda: specs.extract_storage(C("txt"))["value"], _rxi("(\\d+)\\s*(GB|TB)\\s*SSD")),
        "screen": (lambda: specs.extract_screen_size(C("txt")), _rxi('([\\d.]+)\\s*(?:inch|pouces|")')),
        "os": (lambda: specs.extract_os(C("txt"))["name"], "CASE WHEN contains(txt, 'Windows 11') THEN 'Windows' WHEN contains(txt, 'Android 13') THEN 'Android' ELSE '' END"),
        "os_version": (lambda: specs.extract_os(C("txt"))["version"], "CASE WHEN contains(txt, 'Windows 11') THEN '11' WHEN contains(txt, 'Android 13') THEN '13' ELSE '' END"),
        "camera": (lambda: specs.extract_camera(C("txt"))["front"], _rxi("selfie\\s*:?\\s*(\\d+)\\s*MP")),
        "battery": (lambda: specs.extract_battery(C("txt")), _rxi("(\\d+)\\s*mAh")),
        "panel": (lambda: specs.screen_type(C("txt")), f"upper({_rxi('\\b(QLED|OLED|AMOLED|LED|LCD|IPS|Retina)\\b')})"),
        "energy_class": (lambda: specs.extract_energy_class(C("txt")), "CASE WHEN contains(txt, ' A++ ') THEN 'A++' ELSE '' END"),
    },
)

_TEL = "concat('21355', lpad(CAST(o_custkey % 10000000 AS STRING), 7, '0'))"


# C18-C23
@query(
    f"""SELECT o_orderkey AS page_id, concat('u', CAST(o_custkey AS STRING), '@x.org') AS emails, {_TEL} AS phones,
 CASE o_custkey % 3 WHEN 0 THEN concat('https://wa.me/21366', lpad(CAST(o_custkey % 10000000 AS STRING), 7, '0')) ELSE '' END AS whatsapp,
 CASE o_custkey % 4 WHEN 0 THEN concat('https://www.example.com/membre/', CAST(o_custkey AS STRING)) END AS profile FROM orders"""
)
def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = pages.contact_struct(F.lit(""), C("html"), pages.clean_text(C("html")))
    df = frame(spark, sf_dir, "contact_pages").select("page_id", c.alias("c"))
    return df.select("page_id", F.array_join("c.email", ",").alias("emails"), F.array_join("c.phones", ",").alias("phones"), F.array_join("c.whatsapp", ",").alias("whatsapp"), C("c.profile_link").alias("profile"))


# B1, B3, B6, B7, B9 (M1)
@query(
    """, u AS (SELECT concat('https://www.example.com/annonce-a-d', CAST(c_custkey AS STRING)) AS url, c_custkey AS page_id, 0 AS pos FROM customer
 UNION ALL SELECT concat('https://www.example.com/annonce-b-d', CAST(c_custkey % 50 AS STRING)), c_custkey, 1 FROM customer
 UNION ALL SELECT concat('https://www.example.com/annonce-x-d', CAST(c_custkey AS STRING)), c_custkey, 2 FROM customer
 UNION ALL SELECT 'https://cdn.example.com/y', c_custkey, 3 FROM customer),
 f AS (SELECT url, min(page_id) AS page_id, CAST(min_by(pos, page_id) AS INTEGER) AS pos FROM u GROUP BY url)
 SELECT regexp_extract(url, 'd(\\d+)$', 1) AS listing_id, url, page_id, pos FROM f WHERE regexp_extract(url, 'd(\\d+)$', 1) <> '' AND regexp_extract(url, 'd(\\d+)$', 1) NOT IN (SELECT listing_id FROM seen)""",
    "seen",
)
def new_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.build_frontier(frame(spark, sf_dir, "ld_pages"), frame(spark, sf_dir, "seen"))[0].select("listing_id", "url", "page_id", "pos")


# B10
@query("SELECT DISTINCT CAST(o_custkey AS STRING) AS listing_id FROM orders")
def extended_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = frame(spark, sf_dir, "listings_raw").select(pages.listing_id_from_url(C("url")).alias("listing_id"))
    return frontier.extend_seen(frame(spark, sf_dir, "seen"), batch)


# A1, B2, B4, B5
@query(
    """WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS href FROM pages)
 SELECT page_id, href, concat(regexp_extract(url, '^(https?://[^/?#]+)', 1), href) AS link, count(*) AS n FROM h WHERE starts_with(href, '/') GROUP BY ALL"""
)
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = frontier.extract_links(io.read_pages(spark, f"{sf_dir}/pages.parquet")).withColumn("link", pages.resolve_url(C("page_url"), C("href")))
    kept = frontier.filter_listing_links(links, ["://"], r"^https?://[^/]+/", "link")
    return kept.where(F.startswith("href", F.lit("/"))).groupBy("page_id", "href", "link").agg(F.count("*").alias("n"))


# C1, C2, M2 (title and h1 by the parser, and by patterns)
@query(
    """SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) <> '' AS has_title, regexp_extract(html, '<h1>(.*?)</h1>', 1) = regexp_extract(html, '<title>(.*?)</title>', 1) AS same,
 len(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)) AS n_links FROM pages"""
)
def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = jobs.parse_pages(frame(spark, sf_dir, "pages", wide=True))
    return p.select("page_id", (C("title") != "").alias("has_title"), (C("h1") == C("title")).alias("same"), F.size("links").cast("long").alias("n_links"))


# B11, C2, C24, C25
@query(
    """SELECT page_id, contains(lower(html), 'no results found') AS empty_page, page_id % 10 = 0 OR contains(lower(html), 'access denied') AS blocked, contains(lower(html), 'verify you are human') AS captcha,
 trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS clean FROM pages"""
)
def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, sf_dir, "pages").select(
        "page_id", pages.is_empty_result_page(C("html")).alias("empty_page"), pages.is_blocked(F.when(C("page_id") % 10 == 0, 403).otherwise(200), C("html")).alias("blocked"), pages.has_captcha(C("html")).alias("captcha"), pages.clean_text(C("html")).alias("clean")
    )


# B12
@query("SELECT p_partkey, CAST(ceil(p_size / 12.0) AS INTEGER) AS n_pages, unnest(range(1, CAST(ceil(p_size / 12.0) AS INTEGER) + 1)) AS page FROM part WHERE p_size > 0")
def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = frontier.page_plan(frame(spark, sf_dir, "part").withColumnRenamed("p_size", "total_results"))
    return plan.select("p_partkey", "n_pages", C("page").cast("long").alias("page"))


# B13
@query("SELECT o_orderkey AS url, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE c_name END AS employer, c_name AS region FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def merged_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = frame(spark, sf_dir, "orders"), frame(spark, sf_dir, "customer")
    cards = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(C("o_orderkey").alias("url"), C("c_name").alias("employer"), C("c_name").alias("region"))
    details = orders.select(C("o_orderkey").alias("url"), F.when(C("o_orderkey") % 2 == 0, C("o_orderstatus")).otherwise("").alias("employer"))
    return frontier.merge_card_and_detail(cards, details, ["employer", "region"])


# B14
@query(
    """SELECT product_url, string_agg(concat(store, '/', CAST(CAST(round(price * 100) AS BIGINT) AS STRING), '/', cond), ',' ORDER BY store, price, cond) AS offers FROM offers GROUP BY product_url""",
    "offers",
)
def offers_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    trees = frontier.product_offers(frame(spark, sf_dir, "offers").withColumnRenamed("cond", "condition"))
    flat = F.transform("offers", lambda o: F.concat_ws("/", o["store"], F.round(o["price"] * 100).cast("long").cast("string"), o["condition"]))
    return trees.select("product_url", F.array_join(flat, ",").alias("offers"))


# B16
@query("SELECT DISTINCT CAST(o_custkey AS STRING) AS url FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def retry_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = frame(spark, sf_dir, "orders").select(C("o_custkey").cast("string").alias("url"), (C("o_orderstatus") == "F").alias("success"))
    return frontier.failed_urls(orders.select("url").distinct(), orders)


# B15, C10, C13-C17, C28, C29
_columns(
    "url_and_image_rules",
    "listings_raw",
    "row_id",
    {
        "by_param": (lambda: pages.category_from_url(F.concat(C("url"), F.lit("?page=tv"))), "'Tv'"),
        "by_path": (lambda: pages.category_from_url(F.concat(C("url"), F.lit("/audio"))), "'Audio'"),
        "stem": (lambda: pages.strip_extension(F.concat(C("url"), F.lit(".jpg.webp"))), "concat(url, '.jpg')"),
        "image": (lambda: pages.normalize_image_url(F.concat(F.lit("http://x.org/"), C("site"), F.lit("-500x500.jpg.jpg"))), "concat('https://x.org/', site, '.jpg')"),
        "good": (lambda: pages.is_wellformed_image_url(F.when(C("row_id") % 2 == 0, C("url")).otherwise("data:image/png")), "row_id % 2 = 0"),
        "best": (lambda: pages.best_srcset(F.concat(C("url"), F.lit(" 100w, "), C("site"), F.lit(" 200w"))), "site"),
        "proxied": (lambda: pages.unwrap_proxied_image(F.concat(F.lit("/p?url=https%3A%2F%2Fx.org%2F"), C("site"), F.lit("&w=3"))), "concat('https://x.org/', site)"),
        "large": (lambda: pages.high_quality_image(F.concat(C("url"), F.lit("?w=1"))), "concat(url, '?w=1200&q=90')"),
        "images": (lambda: F.array_join(pages.dedupe_images(F.array(F.concat(C("site"), F.lit(".jpg")), F.concat(C("site"), F.lit(".png")), C("category"))), ","), "concat(site, '.jpg,', category)"),
        "cleaned": (lambda: F.array_join(pages.clean_images(F.array(C("site"), F.lit(""), F.lit("data:x"), F.lit("logo.png"), C("site"), C("category"))), ","), "concat(site, ',', category)"),
        "photo": (lambda: money.avec_sans_photo(F.array(F.when(C("row_id") % 2 == 0, C("site")).otherwise(""))), "CASE WHEN row_id % 2 = 0 THEN 'Avec photo' ELSE 'Sans photo' END"),
        "views": (lambda: pages.extract_views_and_number(F.concat(F.lit("Vue: "), C("row_id").cast("string"), F.lit(" Annonce N°: 7")))["views"], "CAST(row_id AS STRING)"),
        "listed": (lambda: F.array_join(pages.split_list_text(F.concat(C("site"), F.lit(" Ou "), C("category"), F.lit(",,"))), "|"), "concat(site, '|', category)"),
        "spec_key": (lambda: pages.normalize_spec_key(F.concat(F.lit("Année - "), C("site"), F.lit(" :"))), "concat('année_', site)"),
    },
)

# C3, C4, C6, C7, C8, C9, C26, C27
_columns(
    "page_classification",
    "listings_raw",
    "row_id",
    {
        "spec": (lambda: F.try_element_at(pages.spec_map_from_lines(F.array(F.concat(F.lit("Prix : "), C("site")), F.lit("x"), F.concat(F.lit("PRIX: "), C("category")))), F.lit("prix")), "category"),
        "rest": (lambda: F.array_join(F.map_keys(pages.split_specs(F.create_map(F.lit("a"), C("site"), F.lit("b"), C("category"), F.lit("c"), F.lit("")), {"a": "x"})[1]), ","), "'b'"),
        "bien": (lambda: pages.breadcrumb_fields(F.array(F.lit("Villa"), F.lit("zz"), F.lit("appartements")), F.array(F.lit("vente"), C("site")))["bien"], "'Appartement'"),
        "crumb_transaction": (lambda: pages.breadcrumb_fields(F.array(F.lit("Villa")), F.array(F.lit("cherche achat"), C("site")))["transaction"], "'Cherche-achat'"),
        "resolved": (lambda: pages.resolve_transaction(F.lit(""), C("site"), F.array(C("category"), F.lit("a louer"))), "'Location'"),
        "km": (lambda: pages.classify_bullets(F.array(F.lit("10 km"), F.lit("2019"), F.lit("BVM6"), F.lit("20 KM THP")))["km"], "'20 KM THP'"),
        "engine": (lambda: pages.classify_bullets(F.array(F.lit("10 km"), F.lit("20 KM THP"), F.concat(F.lit("THP "), C("site"))))["engine"], "concat('THP ', site)"),
        "diplomas": (lambda: F.array_join(pages.classify_requirement_tags(F.array(F.lit("Sur site"), F.lit("Bac +2"), F.lit("Bac"), F.lit("2 ans d'exp")))["diplomas"], ","), "'Bac +2,Bac'"),
        "positions": (lambda: pages.classify_requirement_tags(F.array(C("site")))["positions"], "'1 poste'"),
        "job": (
            lambda: pages.parse_job_posting(F.concat(F.lit('<script type="application/ld+json">{"@type":"JobPosting","title":"'), C("category"), F.lit('","hiringOrganization":{"name":"'), C("site"), F.lit('"},"description":"<b>x</b> y"}</script>')))["employer"],
            "site",
        ),
    },
)

_LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY date_crawl DESC, row_id DESC) AS rn FROM {0}) WHERE rn = 1"


# D2, E1, I3, I5, J1, K1
@query(
    f""", l AS ({_LATEST.format("listings_raw")}), v AS (SELECT category, site, {_FUEL} AS fuel, {_DECIMAL} AS price FROM l)
 SELECT category, site, CAST(sum(CASE WHEN price > 0 THEN 1 ELSE 0 END) AS BIGINT) AS items, CAST(sum(CASE WHEN price > 0 THEN 0 ELSE 1 END) AS BIGINT) AS errors, CAST(grouping(category, site) AS BIGINT) AS level
 FROM v WHERE fuel <> 'Diesel' GROUP BY ROLLUP (category, site)""",
    "listings_raw",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the latest valid version of each listing."""
    last = upsert.latest_per_doc(frame(spark, sf_dir, "listings_raw"), "url", ["date_crawl"], ["row_id"])
    typed = last.withColumns({"energie": vocab.normalize_fuel(C("energie_text")), "price": money.parse_price(C("prix_text"), C("prix_unit"))["decimal"], "cylindree": F.lit(1.6)})
    valid = rows.importable_vehicles(rows.drop_empty_essential(typed, "url"))
    return metrics.run_totals(valid.select("category", "site", (C("price") > 0).cast("long").alias("items"), (C("price") <= 0).cast("long").alias("errors")))


# J1
@query(f", l AS ({_LATEST.format('listings_raw')}) SELECT url, row_id, site, date_text FROM l", "listings_raw")
def latest_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.latest_per_doc(frame(spark, sf_dir, "listings_raw"), "url", ["date_crawl"], ["row_id"]).select("url", "row_id", "site", "date_text")


# J2
@query(
    f""", cur AS ({_LATEST.format("(SELECT * FROM listings_raw WHERE row_id % 2 = 0)")}), bat AS ({_LATEST.format("(SELECT * FROM listings_raw WHERE row_id % 2 = 1)")})
 SELECT url, row_id, date_text FROM bat UNION ALL SELECT url, row_id, date_text FROM cur WHERE url NOT IN (SELECT url FROM bat)""",
    "listings_raw",
)
def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "listings_raw")
    current = upsert.latest_per_doc(df.where("row_id % 2 = 0"), "url", ["date_crawl"], ["row_id"])
    return upsert.upsert(current, df.where("row_id % 2 = 1"), "url", ["date_crawl"], ["row_id"]).select("url", "row_id", "date_text")


# J3, M8
@query(
    f""", cur AS ({_LATEST.format("(SELECT * FROM listings_raw WHERE row_id % 2 = 0)")}), bat AS ({_LATEST.format("(SELECT * FROM listings_raw WHERE row_id % 2 = 1)")})
 SELECT coalesce(b.url, c.url) AS url, coalesce(b.row_id, c.row_id) AS row_id, CASE WHEN b.url IS NULL THEN c.date_text WHEN b.site = 'site1' THEN coalesce(NULLIF(c.date_text, ''), b.date_text) ELSE b.date_text END AS date_depot
 FROM cur c FULL JOIN bat b ON b.url = c.url""",
    "listings_raw",
)
def upserted_first_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "listings_raw").withColumns({"doc_id": rows.doc_id(C("url"), C("site"), C("category")), "date_depot": C("date_text")})
    current = upsert.latest_per_doc(df.where("row_id % 2 = 0"), "doc_id", ["date_crawl"], ["row_id"])
    return jobs.save_listings(current, df.where("row_id % 2 = 1"), C("site") == "site1")[0].select("url", "row_id", "date_depot")


# J4
@query("SELECT energie_text AS titre, row_id FROM (SELECT *, row_number() OVER (PARTITION BY energie_text ORDER BY row_id) AS rn FROM listings_raw) WHERE rn = 1", "listings_raw")
def first_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "listings_raw").withColumnRenamed("energie_text", "titre")
    return upsert.dedupe_by_name(df, "titre", ["row_id"]).select("titre", "row_id")


# I1, I7, I8, J6
@query("SELECT url, category, '' AS titre, 0 AS n_images, coalesce(CAST(strftime(date_crawl, '%Y-%m-%d %H:%M:%S') AS STRING), '') AS date_crawl FROM listings_raw WHERE category IN ('voiture', 'emploi')", "listings_raw")
def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "listings_raw").select("url", "category", F.date_format("date_crawl", "yyyy-MM-dd HH:mm:ss").alias("date_crawl"))
    parts = [rows.fill_nulls(rows.add_crawl_metadata(rows.conform(df.where(C("category") == c), c), _as_of())) for c in ("voiture", "emploi")]
    return upsert.union_sites(parts).select("url", "category", "titre", F.size("images").alias("n_images"), "date_crawl")


# I2, I4, I6, I11, I13, M4
@query(
    f"""SELECT row_id, CAST(regexp_extract(moteur_text, '(20\\d\\d)', 1) AS INTEGER) AS annee, regexp_replace(km_text, '[^0-9]', '', 'g') AS km FROM words
 WHERE k % 9 <> 2 AND CAST(regexp_extract(moteur_text, '(20\\d\\d)', 1) AS INTEGER) >= {int(AS_OF[:4]) - 3} AND NOT (k % 9 IN (0, 1) AND CAST(regexp_extract(moteur_text, '(\\d\\.\\d)', 1) AS DOUBLE) > 1.8)""",
    "words",
)
def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, "words").join(frame(spark, sf_dir, "listings_raw").select("row_id", "energie_text"), "row_id")
    out = jobs.normalize_vehicles(raw, _as_of())
    return out.where(rows.is_complete(["annee", "km"])).select("row_id", "annee", "km")


# I6, M4: model years on both sides of the reference's three years
@query(
    f"""SELECT row_id, CAST(regexp_extract(moteur_text, '(20\\d\\d)', 1) AS INTEGER) AS annee FROM engines
 WHERE k % 9 <> 2 AND CAST(regexp_extract(moteur_text, '(20\\d\\d)', 1) AS INTEGER) >= {int(AS_OF[:4]) - 3} AND NOT (k % 9 IN (0, 1) AND CAST(regexp_extract(moteur_text, '(\\d\\.\\d)', 1) AS DOUBLE) > 1.8)""",
    "engines",
)
def recent_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, "words").drop("moteur_text", "k").join(frame(spark, sf_dir, "engines"), "row_id").join(frame(spark, sf_dir, "listings_raw").select("row_id", "energie_text"), "row_id")
    return jobs.normalize_vehicles(raw, _as_of()).select("row_id", "annee")


# M3
@query(
    f"""SELECT row_id, {_BIEN} AS bien, {_TRANSACTION} AS transaction, CAST(regexp_extract(lot_text, 'F(\\d+)', 1) AS INTEGER) AS nb_pieces, CAST(regexp_extract(lot_text, '(\\d+) m2', 1) AS DOUBLE) AS superficie FROM words WHERE titre <> ''""",
    "words",
)
def real_estate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, "words").withColumns({"prix_text": F.lit(""), "prix_unit": F.lit("")})
    return jobs.normalize_real_estate(raw).select("row_id", "bien", "transaction", "nb_pieces", "superficie")


# M5
@query(
    f"""SELECT row_id, {_case("trim(domaine)", vocab.DOMAINS, "'Autre'")} AS domaine_norm, regexp_replace(regexp_extract(salaire_text, '(\\d[\\d\\s]*)DA', 1), '\\s', '', 'g') AS prix, strftime(DATE '{AS_OF}' - {_AGO}, '%Y-%m-%d') AS date_depot FROM words""",
    "words",
)
def job_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.normalize_jobs(frame(spark, sf_dir, "words"), _as_of()).select("row_id", "domaine_norm", "prix", "date_depot")


# M6, M7
@query(f"SELECT row_id, {_BRAND(vocab.APPLIANCE_BRANDS)} AS marque, {_rxi('Garantie\\s*:?\\s*(\\d+)')} AS garantie, {_rxi('RAM\\s*:?\\s*(\\d+)\\s*(GO|GB)')} AS ram, {_rxi('(\\d+)\\s*mAh')} AS batterie FROM spec_text", "spec_text")
def shop_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = frame(spark, sf_dir, "spec_text")
    a, e = jobs.normalize_appliances(df).select("row_id", "marque", "garantie"), jobs.normalize_electronics(df).select("row_id", "ram", "batterie")
    return a.join(e, "row_id")


# K1
@query("SELECT category, site, CAST(sum(items) AS BIGINT) AS items, CAST(sum(errors) AS BIGINT) AS errors, CAST(grouping(category, site) AS BIGINT) AS level FROM runs GROUP BY ROLLUP (category, site)", "runs")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.run_totals(frame(spark, sf_dir, "runs"))


# K2
@query("SELECT category, CAST(sum(items) AS BIGINT) AS items, CAST(sum(errors) AS BIGINT) AS errors, max(ended) AS last_run, max_by(duration, struct_pack(a := ended, b := duration)) AS last_duration FROM runs GROUP BY category", "runs")
def category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.category_stats(frame(spark, sf_dir, "runs"))


# K3
@query(
    "SELECT cycle, "
    + ", ".join(f"CAST(coalesce(sum(CASE WHEN category = '{c}' THEN items END), 0) AS BIGINT) AS {c}" for c in ("immobilier", "voiture", "emploi", "electromenager", "multimedia"))
    + ", CAST(sum(items) AS BIGINT) AS total, sum(duration) AS duration FROM runs GROUP BY cycle",
    "runs",
)
def cycle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.cycle_summary(frame(spark, sf_dir, "runs"), ["immobilier", "voiture", "emploi", "electromenager", "multimedia"])


# K4, K12
@query("SELECT category, site, CAST(sum(CASE WHEN kind = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS ok, CAST(sum(CASE WHEN kind = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS failed FROM run_events GROUP BY category, site", "run_events")
def log_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(C("kind") == "success", "INFO").when(C("kind") == "error", "ERROR").otherwise("WARNING")
    return metrics.scrape_log_counts(frame(spark, sf_dir, "run_events").withColumn("level", level))


@query("SELECT CAST(count(*) FILTER (WHERE kind = 'success') AS BIGINT) AS success, CAST(count(*) FILTER (WHERE kind <> 'success') AS BIGINT) AS errors FROM run_events", "run_events")
def save_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.save_stats(frame(spark, sf_dir, "run_events").select((C("kind") == "success").alias("ok")))


# A10
@query("SELECT event_id, ts, 'ERROR' AS level, category AS logger, concat(site, ' failed') AS message FROM (SELECT event_id, date_trunc('second', ts) AS ts, category, site FROM run_events WHERE kind = 'error')", "run_events")
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.format_string("[%s] [ERROR] [%s] %s failed", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "category", "site")
    lines = frame(spark, sf_dir, "run_events").where("kind = 'error'").select("event_id", line.alias("value"))
    return io.parse_log_text(lines, keep=["event_id"])


_STREAKS = """, e AS (SELECT *, count(*) FILTER (WHERE kind = 'success') OVER (PARTITION BY category ORDER BY ts, event_id) AS g FROM run_events WHERE kind IN ('error', 'success')),
 s AS (SELECT category, event_id, row_number() OVER (PARTITION BY category, g ORDER BY ts, event_id) AS streak FROM e WHERE kind = 'error')"""
_NTH = ", n AS (SELECT category, event_id, kind, row_number() OVER (PARTITION BY category, kind ORDER BY ts, event_id) AS nth FROM run_events)"


# K9
@query(_STREAKS + " SELECT category, event_id, CAST(streak AS INTEGER) AS streak, streak % 3 = 0 AS alert FROM s", "run_events")
def error_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.error_streaks(frame(spark, sf_dir, "run_events"), 3).select("category", "event_id", "streak", "alert")


# K10, K11, M9
@query(
    _STREAKS
    + _NTH
    + f""" SELECT category, event_id, 'error' AS kind, streak AS reached FROM s WHERE streak % {metrics.ERRORS} = 0
 UNION ALL SELECT category, event_id, kind, nth FROM n WHERE (kind = 'block' AND nth % {metrics.BLOCKS} = 0) OR (kind = 'captcha' AND nth % {metrics.CAPTCHAS} = 0)
 UNION ALL SELECT category, event_id, 'progress', nth FROM n WHERE kind = 'success' AND nth % {metrics.PROGRESS} = 0""",
    "run_events",
)
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.monitor_runs(frame(spark, sf_dir, "run_events"))


# K5
@query(
    """, l AS (SELECT category, count(*) FILTER (WHERE kind = 'success') AS items, count(*) FILTER (WHERE kind = 'block') AS b, max(ts) FILTER (WHERE kind = 'success') AS last_success, max(event_id) FILTER (WHERE kind = 'success') AS last_id FROM run_events GROUP BY category)
 SELECT category, items, (SELECT count(*) FROM run_events r WHERE r.category = l.category AND kind = 'error' AND event_id > last_id) % 10 AS error_streak, b % 5 AS blocks_since_alert, last_success FROM l""",
    "run_events",
)
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.health_report(frame(spark, sf_dir, "run_events"))


_STATS = "SELECT endpoint, count(*) FILTER (WHERE ok) AS successes, count(*) FILTER (WHERE NOT ok) AS failures, count(*) FILTER (WHERE blocked OR NOT ok) AS blocked, avg(CASE WHEN ok THEN latency END) AS latency FROM requests GROUP BY endpoint"


# K6-K8, M10
@query(f", s AS ({_STATS}) SELECT endpoint, successes, failures, blocked, round(latency, 6) AS latency, round(greatest(1.0, 100 - 10 * coalesce(latency, 5.0) - 20 * blocked - 5 * failures), 6) AS score FROM s ORDER BY greatest(1.0, 100 - 10 * coalesce(latency, 5.0) - 20 * blocked - 5 * failures) DESC, endpoint LIMIT 20", "requests")
def best_endpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = jobs.rank_endpoints(frame(spark, sf_dir, "requests"))
    return top.select("endpoint", "successes", "failures", "blocked", F.round("latency", 6).alias("latency"), F.round("score", 6).alias("score"))


# D8-D10, D25, E9, E10, E16, E17, E26, E29, E30, E32
_columns(
    "deals_and_jobs",
    "words",
    "row_id",
    {
        "instalment_total": (lambda: money.instalments(F.concat(C("k").cast("string"), F.lit(" DA")), F.lit("12 mois"), F.lit("5 000 DA"))["total"], "CAST(k * 12 AS DOUBLE)"),
        "first_payment": (lambda: money.instalments(F.lit("1 DA"), F.lit("2"), F.concat(C("k").cast("string"), F.lit(",5 DA")))["premier_versement"], "k + 0.5"),
        "discounted": (lambda: money.discount(F.concat(F.lit("1 200 DA "), C("k").cast("string"), F.lit(" DA")), F.lit("1 200 DA"))["price"], "CAST(k AS STRING)"),
        "tax": (lambda: money.price_and_tax(F.when(C("k") % 2 == 0, "5"), F.lit("6"))["tax"], "CASE WHEN k % 2 = 0 THEN 'HT' ELSE 'TTC' END"),
        "power": (lambda: F.array_join(money.engine_figures(F.concat(C("k").cast("string"), F.lit(" HP 90 CV")))["power"], ","), "concat(CAST(k AS STRING), ',90')"),
        "horses": (lambda: money.horse_power(F.concat(C("k").cast("string"), F.lit("HP"))), "concat(CAST(k AS STRING), ' CV')"),
        "diplomas": (lambda: F.array_join(vocab.extract_diplomes(F.concat(F.lit("Poste. Bac + "), (C("k") % 5 + 1).cast("string"), F.lit(" exigé; autre"))), "|"), "concat(CAST(k % 5 + 1 AS STRING), '|Bac + ', CAST(k % 5 + 1 AS STRING), ' exigé')"),
        "diploma_list": (lambda: F.array_join(vocab.normalize_diplomes(F.array(C("diplome"), F.lit("sans diplôme"))), ","), f"CASE WHEN diplome IN ('', 'pas important') THEN 'Non spécifié' ELSE {_case('lower(diplome)', vocab.DIPLOMAS, 'diplome')} END"),
        "address": (lambda: vocab.compose_address(F.array(F.lit("Adresse"), F.lit("Zones"), F.lit("Région")), F.array(C("adresse"), F.lit("Commune de X"), F.lit("Y")))["address"], "CASE WHEN adresse = '' THEN 'X, Y' ELSE concat(adresse, ', X, Y') END"),
        "world": (lambda: vocab.worldwide_address(F.when(C("k") % 2 == 0, "Plus de villes").otherwise(C("adresse")), F.lit("z"))[0], "CASE WHEN k % 2 = 0 THEN 'Worldwide' ELSE adresse END"),
        "fraud": (lambda: vocab.suspicious_status(F.when(C("k") % 3 == 0, "Nettoyage de billets").otherwise(C("titre"))), "CASE WHEN k % 3 = 0 THEN 404 ELSE 200 END"),
        "card_type": (lambda: vocab.property_words(F.concat(F.lit("Vente "), C("bien_text"))), "CASE k % 8 WHEN 0 THEN 'Appartement' WHEN 1 THEN 'Villa' WHEN 4 THEN 'Terrain agricole' WHEN 5 THEN 'Commerce' WHEN 7 THEN 'Studio' ELSE '' END"),
        "card_region": (lambda: vocab.region_from_card(C("adresse")), "upper(trim(CASE WHEN contains(adresse, ',') THEN split_part(adresse, ',', 2) ELSE adresse END))"),
        "positions": (lambda: vocab.positions(C("km_text")), "CAST(regexp_extract(km_text, '(\\d+)', 1) AS INTEGER)"),
        "title": (lambda: vocab.format_title(F.concat(F.lit("smart tv "), C("boite"))), "CASE k % 6 WHEN 0 THEN 'Smart TV Dct' WHEN 1 THEN 'Smart TV Semi Auto' WHEN 2 THEN 'Smart TV Mt' WHEN 3 THEN 'Smart TV Bv6' WHEN 4 THEN 'Smart TV Boite Automatique' ELSE 'Smart TV' END"),
        "year": (lambda: rows.default_year(F.when(C("k") % 2 == 0, "2020"), _as_of()), f"CASE WHEN k % 2 = 0 THEN '2020' ELSE '{int(AS_OF[:4]) - 3}' END"),
    },
)

# G1, G10, G15, G16
_columns(
    "spec_lines",
    "spec_text",
    "row_id",
    {
        "capacity": (lambda: specs.extract_capacity(F.concat(F.lit("Capacité: "), (C("row_id") % 9 + 1).cast("string"), F.lit(" litres")))["value"], "CAST(row_id % 9 + 1 AS STRING)"),
        "capacity_unit": (lambda: specs.extract_capacity(F.lit("7 kg"))["unit"], "'kg'"),
        "processor": (lambda: specs.extract_processor(F.concat(F.lit("CPU: Core i"), (C("row_id") % 9).cast("string"), F.lit(" (2.4 GHz)"))), "concat('Core i', CAST(row_id % 9 AS STRING), ' (2.4 GHz)')"),
        "model": (lambda: vocab.extract_model(F.concat(F.lit("LG WX-"), (C("row_id") % 900 + 100).cast("string")), vocab.APPLIANCE_MODELS), "concat('WX-', CAST(row_id % 900 + 100 AS STRING))"),
        "from_lines": (lambda: specs.specs_from_lines(F.array(F.lit("RAM: 4 GB"), F.lit("x")), C("txt"))["ram"], "'4'"),
        "from_text": (lambda: specs.specs_from_lines(F.array(F.lit("y"), F.lit("x")), C("txt"))["ram"], _rxi("RAM\\s*:?\\s*(\\d+)\\s*(GO|GB)")),
        "override": (lambda: specs.specs_table_override(F.create_map(F.lit("RAM"), F.lit("16")), "RAM", C("txt")), "'16'"),
        "fill": (lambda: specs.specs_table_override(F.create_map(F.lit("RAM"), F.lit("16")), "RAM", specs.extract_battery(C("txt")), False), _rxi("(\\d+)\\s*mAh")),
    },
)


# I12
@query("SELECT page_id, regexp_extract(url, '^(https?)', 1) AS scheme, 'Avec photo' AS as_photo, CAST(page_id AS DOUBLE) AS prix_dec, CASE WHEN page_id = 0 THEN 'Sans prix' ELSE 'Avec prix' END AS as_prix FROM pages")
def tv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = frame(spark, sf_dir, "pages").select("page_id", "url", F.lit("<b>TV</b>").alias("title"), F.concat(C("page_id").cast("string"), F.lit(" DZD")).alias("price"), F.array(F.lit("http://x.org/a-300x300.jpg")).alias("images"))
    made = rows.format_tv_record(raw).withColumn("page_id", C("prix_dec").cast("long"))
    return made.select("page_id", F.regexp_extract("url", "^(https?)", 1).alias("scheme"), "as_photo", "prix_dec", "as_prix")


# K7, unseen endpoints
@query(f", s AS ({_STATS}), e AS (SELECT DISTINCT concat('ep', CAST(event_id % 60 AS STRING)) AS endpoint FROM requests) SELECT e.endpoint, round(CASE WHEN s.endpoint IS NULL THEN 50.0 ELSE greatest(1.0, 100 - 10 * coalesce(latency, 5.0) - 20 * blocked - 5 * failures) END, 6) AS score FROM e LEFT JOIN s ON e.endpoint = s.endpoint", "requests")
def endpoint_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = frame(spark, sf_dir, "requests")
    asked = requests.select(F.concat(F.lit("ep"), (C("event_id") % 60).cast("string")).alias("endpoint")).distinct()
    scored = metrics.score_of(asked, metrics.endpoint_score(metrics.endpoint_stats(requests)))
    return scored.select("endpoint", F.round("score", 6).alias("score"))
