"""The jobs: whole-table pipelines over the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import base, dates, details, money, pages, specs, vocab
from ..operators import frontier, metrics, rows, upsert
from ..sources import html, io


def _given(df: DataFrame, rules: dict[str, tuple[str, Callable[[], Column]]]) -> DataFrame:
    """The columns whose sources (named with blanks between) the table has; a rule may read the table's own column of its name."""
    return df.withColumns({name: make() for name, (sources, make) in rules.items() if set(sources.split()) <= set(df.columns)})


def _images() -> Column:
    return pages.dedupe_images(pages.clean_images(F.transform("images", pages.normalize_image_url)))


def build_frontier(page_table: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New unique listings of the pages that are usable, and the extended seen set."""
    usable = page_table.where(~pages.is_empty_result_page(F.col("html")) & ~pages.has_captcha(F.col("html")) & ~pages.is_blocked(F.lit(200), F.col("html")))
    links = frontier.links_with_fallback(usable).where(F.startswith("url", F.lit("http")))
    found = frontier.dedupe_links(links).withColumn("listing_id", pages.listing_id_from_url(F.col("url")))
    fresh = frontier.new_listings(found, seen)
    return fresh, frontier.extend_seen(seen, fresh)


def parse_pages(page_table: DataFrame) -> DataFrame:
    """One parse a page, then columns."""
    p = html.parse_pages(page_table)
    return p.select("page_id", "url", "title", html.extract_text(F.col("elements"), "h1").alias("h1"), "links", "images", html.spec_map(F.col("pairs")).alias("specs"), "visible")


def normalize_real_estate(df: DataFrame) -> DataFrame:
    """titre, bien_text, lot_text, prix_text, prix_unit, adresse -> typed columns.

    Where the table has them: breadcrumbs (``crumbs``, ``crumb_links``, ``chips``) settle type and transaction, ``date_text`` the date,
    ``images`` are cleaned, and parsed elements (``elements`` or those ``found`` by selectors, ``strings``) give place, address and contact."""
    price = money.parse_price(F.col("prix_text"), F.col("prix_unit"))
    area = money.extract_superficie(F.col("lot_text"))
    place = vocab.split_wilaya_commune(F.col("adresse"))
    typed = rows.drop_empty_essential(df).withColumns(
        {
            "bien": vocab.convert_property_type(F.col("bien_text")),
            "transaction": vocab.detect_transaction(F.col("titre")),
            "prix_dec": price["decimal"],
            "nb_pieces": money.extract_rooms_number(F.col("lot_text")).try_cast("int"),
            "superficie": area["value"],
            "etage": money.extract_etage_number(F.col("lot_text")),
            "wilaya": place["wilaya"],
            "commune": place["commune"],
            "as_prix": money.avec_sans_prix(price["decimal"], price["unit"]),
        }
    )
    crumb = lambda: pages.breadcrumb_fields(F.col("crumbs"), F.col("crumb_links"))
    spot = lambda field, other: F.coalesce(base.some(F.col("_spot")[field]), F.col(other))
    read = "found strings" if "found" in df.columns else "elements strings"
    location, contact = (details.location_of, details.contact_of) if "found" in df.columns else (details.location, details.contact)
    page = lambda rule: lambda: rule(*map(F.col, read.split()))
    typed = _given(typed, {"_spot": (read, page(location))})
    more = _given(
        typed,
        {
            "bien": ("crumbs crumb_links", lambda: F.coalesce(base.let(crumb()["bien"], base.some), F.col("bien"))),
            "transaction": ("crumbs crumb_links chips", lambda: pages.resolve_transaction(crumb()["transaction"], F.col("titre"), F.col("chips"))),
            "date_depot": ("date_text", lambda: dates.parse_date(F.col("date_text"))),
            "images": ("images", _images),
            "wilaya": (read, lambda: spot("wilaya", "wilaya")),
            "commune": (read, lambda: spot("commune", "commune")),
            "adresse": (read, lambda: spot("address", "adresse")),
        },
    )
    # in the last step, so that a query that takes one field of it works out only that
    return _given(more, {"as_photo": ("images", lambda: money.avec_sans_photo(F.col("images"))), "contact": (read, page(contact))}).drop("_spot")


def normalize_vehicles(df: DataFrame, as_of: Column, years: int = 3) -> DataFrame:
    """energie_text, boite, km_text, moteur_text -> typed columns; only importable vehicles of the last ``years`` model years stay.

    Where the table has them: price texts, titles, brands and models in standard form, and a status by the description."""
    typed = df.withColumns(
        {
            "energie": vocab.normalize_fuel(F.col("energie_text")),
            "transmission": vocab.normalize_transmission(F.col("boite")),
            "km": money.normalize_mileage(F.col("km_text"))["km"],
            "annee": money.normalize_year(F.col("moteur_text")),
            "cylindree": money.extract_engine_size(F.col("moteur_text")),
        }
    )
    priced = lambda: money.parse_price(F.col("prix_text"), F.col("prix_unit"))
    more = _given(
        typed,
        {
            "prix": ("prix_text prix_unit", lambda: priced()["display"]),
            "prix_value": ("prix_text prix_unit", lambda: priced()["value"]),
            "prix_dec": ("prix_text prix_unit", lambda: money.vehicle_price(F.col("prix_text"), F.col("prix_unit"))),
            "export": ("prix_unit", lambda: money.export_flag(F.col("prix_unit"))),
            "titre": ("titre", lambda: vocab.format_title(F.col("titre"))),
            "marque": ("marque", lambda: vocab.format_title(F.col("marque"))),
            "model": ("model", lambda: vocab.format_title(F.col("model"))),
            "status": ("description", lambda: vocab.suspicious_status(F.col("description"))),
        },
    )
    return rows.recent_vehicles(rows.importable_vehicles(more), as_of, years)


def normalize_jobs(df: DataFrame, as_of: Column) -> DataFrame:
    """domaine, diplome, adresse, salaire_text, quand -> typed columns.

    Where the table has them: the title settles an unknown domain (``domaine_complet``), the description names diplomas, and salary ranges, experience,
    contract, region and lists of levels are put in standard form."""
    salary = money.extract_salary(F.col("salaire_text"))
    typed = df.withColumns(
        {
            "domaine_norm": vocab.normalize_domaine(F.col("domaine")),
            "diplome_norm": vocab.normalize_diplome(F.col("diplome")),
            "wilaya": vocab.extract_wilaya(F.col("adresse")),
            "prix": salary["amount"],
            "prix_unit": salary["unit"],
            "date_depot": dates.normalize_date(F.col("quand"), as_of),
        }
    )
    from_title = lambda: F.when(F.col("domaine_norm") == "Autre", vocab.domain_from_title(F.col("titre"))).otherwise(F.col("domaine_norm"))
    named = lambda: vocab.extract_diplomes(F.col("description"))
    own = lambda: F.filter(F.array("diplome"), lambda d: ~base.blank(d))
    wage = lambda: money.extract_salary_range(F.col("salaire_text"))
    return _given(
        typed,
        {
            "domaine_complet": ("titre", from_title),
            "diplome_src": ("description", named),
            "diplomes": ("description", lambda: vocab.normalize_diplomes(F.array_distinct(F.concat(own(), named())), F.col("description"))),
            "prix_value": ("salaire_text", lambda: wage()["salary"]),
            "as_prix": ("salaire_text", lambda: wage()["as_prix"]),
            "experience": ("experience", lambda: vocab.normalize_experience_2(F.col("experience"))),
            "contrat": ("contrat", lambda: vocab.normalize_contrat(F.col("contrat"))),
            "wilaya": ("city", lambda: vocab.wilaya_from_city(F.col("city"))),
            "date_depot": ("since", lambda: dates.relative_date(F.col("since"), as_of)),
            "niveau": ("niveau_text", lambda: pages.split_list_text(F.col("niveau_text"))),
        },
    )


def _prices(plans: str = "plan_text") -> dict[str, tuple[str, Callable[[], Column]]]:
    """Price and instalments of a shop's product; a price of its own comes before what the plans add up to."""
    paid = lambda: money.parse_instalments(F.col(plans))
    return {
        "prix_dec": ("prix_text", lambda: money.str_to_float(F.col("prix_text"))),
        "par_facilite": (plans, lambda: paid()["par_facilite"]),
        "prix_facilite": (plans, lambda: paid()["prix_facilite"]),
        "premier_versement": (plans, lambda: paid()["premier_versement"]),
        "premier_versement_value": (plans, lambda: paid()["premier_versement_value"]),
        "total_facilite": (plans, lambda: paid()["total"]),
        "images": ("images", _images),
    }


def normalize_appliances(df: DataFrame, text: str = "txt") -> DataFrame:
    """A text column -> technical figures; prices, instalments and images where the table has them."""
    t = F.col(text)
    typed = df.withColumns(
        {
            "categorie": vocab.normalize_categorie_appliance(t),
            "marque": vocab.extract_brand(t, vocab.APPLIANCE_BRANDS),
            "modele": vocab.extract_model(t, vocab.APPLIANCE_MODELS),
            "etat": vocab.normalize_etat(t, F.lit("")),
            "capacite": specs.extract_capacity(t)["value"],
            "puissance": specs.extract_power(t)["value"],
            "poid": specs.extract_weight(t)["value"],
            "couleur": specs.extract_color(t),
            "garantie": specs.extract_warranty(t)["value"],
            "garantie_unit": specs.extract_warranty(t)["unit"],
            "energie": specs.extract_energy_class(t),
            "dimension": specs.extract_dimensions(t),
        }
    )
    return _given(typed, _prices())


def normalize_electronics(df: DataFrame, text: str = "txt", as_of: Column | None = None) -> DataFrame:
    """A text column -> technical figures; lines (``lines``) and spec tables (``specs``) come before the text, prices and dates where the table has them."""
    t = F.col(text)
    typed = df.withColumns(
        {
            "categorie": vocab.normalize_categorie_electronics(t),
            "marque": vocab.extract_brand(t, vocab.ELECTRONICS_BRANDS),
            "etat": vocab.normalize_etat(t, F.lit(""), "electronics"),
            "ram": specs.extract_ram(t)["value"],
            "m_interne": specs.extract_storage(t)["value"],
            "taille_ecran": specs.extract_screen_size(t),
            "os": specs.extract_os(t)["name"],
            "os_version": specs.extract_os(t)["version"],
            "batterie": specs.extract_battery(t),
            "camera_av": specs.extract_camera(t)["front"],
            "type_ecran": specs.screen_type(t),
            "modele": vocab.extract_model(t, vocab.ELECTRONICS_MODELS),
            "garantie": specs.extract_warranty(t)["value"],
            "garantie_unit": specs.extract_warranty(t)["unit"],
            "processor": specs.extract_processor(t),
        }
    )
    by_line = lambda: specs.specs_from_lines(F.col("lines"), t)
    more = _given(typed, {"processor": ("lines", lambda: by_line()["processor"]), "couleur": ("lines", lambda: by_line()["color"]), "poid": ("lines", lambda: by_line()["weight"])} | _prices())
    more = _given(more, {"m_interne": ("specs", lambda: specs.specs_table_override(F.col("specs"), "stockage", F.col("m_interne"))), "ram": ("specs", lambda: specs.specs_table_override(F.col("specs"), "ram", F.col("ram")))})
    return more if as_of is None else _given(more, {"date_depot": ("date_text", lambda: dates.month_name_date(F.col("date_text"), as_of))})


def save_listings(current: DataFrame, batch: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """The new state of the table, and the rows that fail (no url, or no id)."""
    if {"prix_unit", "category", "export"} <= set(batch.columns):  # a vehicle priced in dinars is none for export
        batch = batch.withColumn("export", F.when((F.col("category") == "voiture") & (F.col("prix_unit") == "DA"), "false").otherwise(F.col("export")))
    good, bad = io.split_failed(batch, ~base.blank(F.col("url")) & F.col("doc_id").isNotNull())
    return upsert.upsert_keep_first_date(current, good, keep, tie=["row_id"]), bad


def monitor_runs(events: DataFrame) -> DataFrame:
    """All alerts of the log in one table: category, event_id, kind, reached."""
    return metrics.alerts(events).drop("ts")


def rank_endpoints(requests: DataFrame, n: int = 20) -> DataFrame:
    return metrics.top_endpoints(metrics.endpoint_score(metrics.endpoint_stats(requests)), n)
