"""Fields of a detail page, read from its elements by selectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dom
from .base import let, some, text
from .pages import PHONE

# ---- fixed values: selectors of the detail pages ----
ROWS, PLACE_ICON, ADDRESS_ICON = "ul.ok-list li", ".__prepend i.mdi-map-marker", ".__prepend i.mdi-home-map-marker"
WRAPPED, TITLE = ".__content .__title .text-wrap", ".__content .__title"
MAIL, CALL, BUTTONS = 'a[href^="mailto:"]', 'a[href^="tel:"]', "#announcementUserInfo a.v-btn, #announcementUserInfo a.ok-list-item"
WHATSAPP, TELEGRAM, VIBER = 'a[href*="wa.me"], a[href*="whatsapp.com"]', 'a[href*="t.me"]', 'a[href^="viber://"]'
# ---- end of fixed values ----
PLACE = {"rows": ROWS, "wrapped": WRAPPED, "titles": TITLE, "place_icons": PLACE_ICON, "address_icons": ADDRESS_ICON}
CONTACT = {"mails": MAIL, "calls": CALL, "buttons": BUTTONS, "whatsapp": WHATSAPP, "telegram": TELEGRAM, "viber": VIBER}


def _selected(elements: Column, selectors: dict[str, str]) -> Column:
    return F.struct(*(dom.select(elements, s).alias(n) for n, s in selectors.items()))


def location(elements: Column, strings: Column) -> Column:
    """struct(wilaya, commune, address): the place is parted at its first ' - ', else at its first hyphen."""
    return let(_selected(elements, PLACE), lambda found: location_of(found, strings))


def location_of(found: Column, strings: Column) -> Column:
    """``location`` of the elements that the selectors of ``PLACE`` found."""

    def marked(icons: str) -> Column:
        """Text beside the first list row with an icon."""
        row = dom.first(F.filter(found["rows"], lambda r: dom.has(found[icons], r)))
        beside = lambda r: F.coalesce(dom.first(dom.inside(found["wrapped"], r)), dom.first(dom.inside(found["titles"], r)))
        return text(let(let(row, beside), lambda e: dom.text(e, strings, " ")))

    def parted(full: Column) -> Column:
        mark = F.when(F.contains(full, F.lit(" - ")), " - ").otherwise("-")
        at = F.instr(full, mark)
        wilaya = F.when(at > 0, F.substring(full, F.lit(1), at - 1)).otherwise(full)
        commune = F.when(at > 0, F.substring(full, at + F.length(mark), F.length(full))).otherwise("")
        return F.struct(F.trim(wilaya).alias("wilaya"), F.trim(commune).alias("commune"))

    return let(let(marked("place_icons"), parted), lambda p: F.struct(p["wilaya"].alias("wilaya"), p["commune"].alias("commune"), marked("address_icons").alias("address")))


def _digits(col: Column) -> Column:
    return F.regexp_replace(col, r"[^0-9]+", "")


def _links(found: Column, pattern: str, prefix: str) -> Column:
    """Distinct links of a service, rebuilt from the number in them."""
    numbers = F.transform(dom.attrs(found, "href"), lambda h: some(F.regexp_extract(h, pattern, 1)))
    return F.array_distinct(F.transform(F.filter(numbers, lambda n: n.isNotNull()), lambda n: F.concat(F.lit(prefix), n)))


def contact(elements: Column, strings: Column) -> Column:
    """struct(email, phones, whatsapp, telegram, viber): distinct values in page order; numbers of links before those in button texts."""
    return contact_of(_selected(elements, CONTACT), strings)


def contact_of(found: Column, strings: Column) -> Column:
    """``contact`` of the elements that the selectors of ``CONTACT`` found."""
    mails = F.transform(dom.attrs(found["mails"], "href"), lambda h: F.lower(F.trim(F.replace(h, F.lit("mailto:"), F.lit("")))))
    linked = dom.attrs(found["calls"], "href")
    shown = F.flatten(F.transform(dom.texts(found["buttons"], strings, ""), lambda t: F.regexp_extract_all(t, F.lit(f"({PHONE})"), F.lit(1))))
    numbers = F.filter(F.transform(F.concat(linked, shown), _digits), lambda d: F.length(d) >= 9)
    viber = F.transform(dom.attrs(found["viber"], "href"), lambda h: F.trim(h))
    return F.struct(
        F.array_distinct(F.filter(mails, lambda m: m != "")).alias("email"),
        F.array_distinct(numbers).alias("phones"),
        _links(found["whatsapp"], r"wa\.me/(\+?\d+)", "https://wa.me/").alias("whatsapp"),
        _links(found["telegram"], r"t\.me/(\+?\d+)", "https://t.me/").alias("telegram"),
        F.array_distinct(viber).alias("viber"),
    )
