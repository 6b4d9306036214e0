"""Columns from page text: urls, images, contacts, spec maps, classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import choose, contains_any, let, rest_of, some, take, text
from .vocab import clean_property_type, lowered, transaction_of_lowered, type_of_clean

# ---- fixed values ----
CAPTCHA_MARKERS = ['id="challenge-form"', 'id="cf-challenge"', 'class="g-recaptcha"', 'id="hcaptcha-box"', "verify you are human", "checking your browser before accessing"]
NO_RESULT_MARKERS = ["aucune annonce trouvée", "aucun résultat ne correspond", "no results found"]
URL_CATEGORIES = [
    ("appareils-photos", "Appareils Photos"), ("consoles-de-jeux", "Consoles de Jeux"), ("demodulateur", "Demodulateurs"), ("manettes-de-jeux", "Manettes de Jeux"),
    ("smartwatch", "Smartwatch"), ("tablettes-tactiles", "Tablettes Tactiles"), ("telephones-mobiles", "Smartphones"), ("tv", "Téléviseurs"), ("audio", "Audio"),
    ("chargeurs", "Chargeurs"), ("memoires", "Memoires"), ("power-bank", "Power Bank"),
]
USER_ID_PATTERNS = [r'"userId"\s*:\s*"?(\d+)"?', r'"user"\s*:\s*\{[^}]*?"id"\s*:\s*(\d+)', r"store\.user\.id\s*=\s*(\d+)", r"/membre/(\d+)", r'"@id":\s*"[^"]*/membre/(\d+)"']
PHONE = r"(?:0|\+213)\s?[567]\d\s?\d{2}\s?\d{2}\s?\d{2}"
BREADCRUMB_TRANSACTIONS = ["Vente", "Location", "Location-vacances", "Location vacances", "Echange", "Cherche-achat", "Cherche-location", "Cherche achat", "Cherche location"]
#: Patterns of a listing's number in its url, by rule.
NUMBER_RULES = {"dashes": r"-(\d+)-", "last_number": r"/(\d+)$", "query_id": r"[?&]id=(\d+)", "sku": r"(?:sku|usedcar)-[^/-]*-(\w+)", "job": r"/job(?:-apply)?/([^/?#]+)", "last_dash": r"-([^-/?#]+)/?$", "last_part": r"/([^/?#]+)/?$"}
# ---- end of fixed values ----

_STRINGS = "array<string>"


def clean_text(col: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text(col), r"<[^>]+>", " "), r"\s+", " "))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of an href on page ``base``; null for other schemes and bare fragments."""
    host = take(base, r"^(https?://[^/?#]+)")
    return choose([(href.rlike(r"^https?://"), href), (F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href)), (F.startswith(href, F.lit("/")), F.concat(host, href))], F.lit(None).cast("string"))


def listing_id_from_url(url: Column) -> Column:
    return F.coalesce(take(url, r"d(\d+)$"), take(url, r"(\d+)$"))


def numero_from_url(url: Column, rule: str) -> Column:
    return F.coalesce(take(url, NUMBER_RULES[rule]), F.lit(""))


def doc_file_stem(url: Column, numero: Column, title: Column) -> Column:
    """Number, else the url's last part, else the title: safe characters, at most 64."""
    last = F.element_at(F.split(F.regexp_replace(text(url), r"/+$", ""), "/"), -1)
    chosen = F.coalesce(some(text(numero)), some(last), F.replace(text(title), F.lit(" "), F.lit("-")))
    return F.substring(F.regexp_replace(chosen, r"[^0-9A-Za-z_-]", ""), 1, 64)


def category_from_url(url: Column) -> Column:
    """Query parameter ``page`` with a capital, else the first path key, else ''."""
    page = F.try_parse_url(url, F.lit("QUERY"), F.lit("page"))
    path = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")))
    capital = F.concat(F.upper(F.substring(page, 1, 1)), F.lower(rest_of(page)))
    return F.coalesce(capital, choose([(F.contains(path, F.lit(k)), v) for k, v in URL_CATEGORIES], F.lit("")))


def is_empty_result_page(html: Column) -> Column:
    return contains_any(F.lower(text(html)), NO_RESULT_MARKERS)


def is_blocked(status: Column, html: Column) -> Column:
    return F.coalesce(status.isin(403, 429), F.lit(False)) | F.contains(F.lower(text(html)), F.lit("access denied"))


def has_captcha(html: Column) -> Column:
    return contains_any(F.lower(text(html)), CAPTCHA_MARKERS)


# ---- images ----
def strip_extension(url: Column) -> Column:
    """The url without its last file extension; a leading dot of a name is none."""
    return F.regexp_replace(text(url), r"(?<=[^/.])\.[^./]*$", "")


def dedupe_images(images: Column) -> Column:
    """One image for each url without extension, the first."""

    def firsts(found: Column) -> Column:
        return let(F.transform(found, strip_extension), lambda stems: F.filter(found, lambda x, i: F.array_position(stems, F.get(stems, i)) == i + 1))

    return let(images, firsts)


def clean_images(images: Column, drop: tuple[str, ...] = ("placeholder", "logo", "loader")) -> Column:
    return F.array_distinct(F.filter(F.coalesce(images, F.array().cast(_STRINGS)), lambda x: (text(x) != "") & ~F.startswith(x, F.lit("data:")) & ~contains_any(F.lower(x), list(drop))))


def normalize_image_url(url: Column) -> Column:
    out = F.regexp_replace(text(url), r"-(?:500x500|300x300|143x83|167x93|771x1024|rotated)(?=\.|$)", "")
    out = F.replace(F.replace(out, F.lit(".jpg.jpg"), F.lit(".jpg")), F.lit(".png.png"), F.lit(".png"))
    return F.regexp_replace(out, r"^http://", "https://")


def is_wellformed_image_url(url: Column) -> Column:
    return F.coalesce(~F.startswith(text(url), F.lit("data:image")) & url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/\s]+"), F.lit(False))


def best_srcset(srcset: Column) -> Column:
    return F.element_at(F.split(F.trim(F.element_at(F.split(text(srcset), ","), -1)), r"\s+"), 1)


def unwrap_proxied_image(src: Column) -> Column:
    return F.coalesce(F.try_url_decode(take(src, r"url=([^&\s]+)")), text(src))


def high_quality_image(url: Column, query: str = "w=1200&q=90") -> Column:
    return F.concat(F.element_at(F.split(text(url), r"\?"), 1), F.lit("?" + query))


# ---- contacts ----
def extract_emails(html: Column) -> Column:
    found = F.regexp_extract_all(text(html), F.lit(r"""href\s*=\s*["']?mailto:([^"'\s>]*)"""), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.lower(F.trim(x))), lambda x: x != ""))


def _digits(col: Column) -> Column:
    return F.regexp_replace(col, r"[^0-9]", "")


def extract_phones(html: Column, visible: Column) -> Column:
    links = F.regexp_extract_all(text(html), F.lit(r"""href\s*=\s*["']?tel:([^"'>]*)"""), F.lit(1))
    shown = F.regexp_extract_all(text(visible), F.lit(f"({PHONE})"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(F.concat(links, shown), _digits), lambda x: F.length(x) >= 9))


def extract_social(html: Column) -> Column:
    def links(pattern: str, prefix: str) -> Column:
        return F.array_distinct(F.transform(F.regexp_extract_all(text(html), F.lit(pattern), F.lit(1)), lambda x: F.concat(F.lit(prefix), x)))

    return F.struct(
        links(r"\bwa\.me/(\+?\d+)", "https://wa.me/").alias("whatsapp"),
        links(r"\bt\.me/(\+?\d+)", "https://t.me/").alias("telegram"),
        links(r'href="viber://([^"]*)"', "viber://").alias("viber"),
    )


def phones_or_social(phones: Column, social: Column) -> Column:
    links = F.concat(social["whatsapp"], social["telegram"], social["viber"])
    numbers = F.flatten(F.transform(links, lambda x: F.regexp_extract_all(x, F.lit(r"(\+?\d{9,15})"), F.lit(1))))
    return F.when(F.size(phones) > 0, phones).otherwise(F.array_distinct(F.transform(numbers, _digits)))


def profile_link(html: Column, site: str = "https://www.example.com") -> Column:
    return F.concat(F.lit(f"{site}/membre/"), F.coalesce(*(take(html, p) for p in USER_ID_PATTERNS)))


def contact_struct(name: Column, html: Column, visible: Column) -> Column:
    """The contact sub-document; its arrays are never null."""
    social = extract_social(html)
    return F.struct(
        some(F.trim(text(name))).alias("name"), profile_link(html).alias("profile_link"), extract_emails(html).alias("email"),
        phones_or_social(extract_phones(html, visible), social).alias("phones"), social["whatsapp"].alias("whatsapp"), social["telegram"].alias("telegram"), social["viber"].alias("viber"),
    )


# ---- specs and lists ----
def normalize_spec_key(label: Column, fold: bool = False) -> Column:
    low = F.replace(F.lower(text(label)), F.lit(":"), F.lit(""))
    low = F.translate(low, "àâäçéèêëîïôöùûü", "aaaceeeeiioouuu") if fold else low
    return F.regexp_replace(F.regexp_replace(F.trim(low), r"(?U)\W+", "_"), r"^_|_$", "")


def last_wins_map(pairs: Column) -> Column:
    """Map of an array of (label, value) structs; of equal labels the last counts, whatever the session's policy."""

    def kept(ps: Column) -> Column:
        return let(F.reverse(ps["label"]), lambda keys: F.filter(ps, lambda p, i: F.array_position(keys, p["label"]) == F.size(keys) - i))

    return F.map_from_entries(F.transform(let(pairs, kept), lambda p: F.struct(p["label"], p["value"])))


def spec_map_from_lines(lines: Column) -> Column:
    """'label : value' lines as a map, labels lower-cased."""
    whole = F.filter(lines, lambda x: F.contains(x, F.lit(":")))
    pairs = F.transform(whole, lambda x: F.struct(F.lower(F.trim(F.split(x, ":", 2)[0])).alias("label"), F.trim(F.split(x, ":", 2)[1]).alias("value")))
    return last_wins_map(pairs)


def split_specs(specs: Column, mapped: dict[str, str]) -> tuple[dict[str, Column], Column]:
    """Known keys as columns, and the non-empty rest as a map."""
    known = {column: F.coalesce(F.try_element_at(specs, F.lit(key)), F.lit("")) for key, column in mapped.items()}
    return known, F.map_filter(specs, lambda k, v: ~k.isin(list(mapped)) & (text(v) != ""))


def breadcrumb_fields(names: Column, links: Column) -> Column:
    """struct(bien, transaction): the last valid entry of each."""
    types = F.filter(F.transform(F.transform(names, clean_property_type), type_of_clean), lambda x: x != "")
    capital = F.transform(links, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(rest_of(x))))
    trans = F.transform(F.filter(capital, lambda x: x.isin(BREADCRUMB_TRANSACTIONS)), lambda x: F.replace(x, F.lit(" "), F.lit("-")))
    return F.struct(F.coalesce(F.try_element_at(types, F.lit(-1)), F.lit("")).alias("bien"), F.coalesce(F.try_element_at(trans, F.lit(-1)), F.lit("")).alias("transaction"))


def resolve_transaction(crumb: Column, title: Column, chips: Column) -> Column:
    found = lambda col: let(let(lowered(col), transaction_of_lowered), some)
    return F.coalesce(let(text(crumb), some), found(title), found(F.array_join(chips, " ")), F.lit("Non spécifié"))


def classify_bullets(bullets: Column) -> Column:
    """struct(km, year, gearbox, fuel, engine): each bullet goes to its first rule, the last bullet of a rule counts."""
    rules = [
        ("km", lambda x: F.contains(F.upper(x), F.lit("KM"))),
        ("year", lambda x: x.rlike(r"^\d{4}$")),
        ("gearbox", lambda x: F.contains(F.upper(x), F.lit("BVM"))),
        ("fuel", lambda x: F.upper(x).isin("ESSENCE", "DIESEL")),
        ("engine", lambda x: F.contains(F.upper(x), F.lit("THP"))),
    ]
    return _routed(bullets, rules)


def _routed(items: Column, rules) -> Column:
    def exclusive(n: int):
        def fits(x: Column) -> Column:
            out = rules[n][1](x)
            for _, before in rules[:n]:
                out = out & ~before(x)
            return out

        return fits

    return F.struct(*(F.coalesce(F.try_element_at(F.filter(items, exclusive(n)), F.lit(-1)), F.lit("")).alias(name) for n, (name, _) in enumerate(rules)))


def classify_requirement_tags(tags: Column) -> Column:
    """struct(contract, diplomas, experience, positions)."""
    low = F.lower

    def contract(x):
        return contains_any(low(x), ["site", "teletravail", "remote"])

    def diploma(x):
        return ~contract(x) & contains_any(low(x), ["bac", "+"])

    def experience(x):
        return ~contract(x) & ~diploma(x) & F.contains(low(x), F.lit("an")) & F.contains(low(x), F.lit("exp"))

    def positions(x):
        return ~contract(x) & ~diploma(x) & ~experience(x) & F.contains(low(x), F.lit("poste"))

    def last(rule, default=""):
        return F.coalesce(F.try_element_at(F.filter(tags, rule), F.lit(-1)), F.lit(default))

    return F.struct(last(contract).alias("contract"), F.filter(tags, diploma).alias("diplomas"), last(experience).alias("experience"), last(positions, "1 poste").alias("positions"))


def extract_views_and_number(col: Column) -> Column:
    return F.struct(F.coalesce(take(col, r"Vue:\s*(\d+)"), F.lit("")).alias("views"), F.coalesce(take(col, r"Annonce N°:\s*(\d+)"), F.lit("")).alias("number"))


def split_list_text(col: Column, sep: str = ",") -> Column:
    """Text list -> trimmed non-empty array; a lone 'Ou' separates like the mark."""
    clean = F.regexp_replace(text(col), r"\bOu\b", sep)
    return F.filter(F.transform(F.split(clean, r"\|" if sep == "|" else sep), lambda x: F.trim(x)), lambda x: x != "")


#: One item of a list written as text: in either quotes, with escapes, or bare. The quantifiers never go back, so long items need no stack.
_ITEM = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\s,\[\]'"][^,\[\]'"]*+"""
_ESCAPE = r"(?s)\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\.|[^\\]++"


def _unescaped(piece: Column) -> Column:
    """A run of plain characters, or one escape."""
    kind = F.substring(piece, 1, 2)
    wide = F.lpad(F.substring(piece, F.lit(3), F.length(piece)), 8, "0")
    return (
        F.when(~F.startswith(piece, F.lit("\\")), piece)
        .when(kind.isin("\\x", "\\u", "\\U") & (F.length(piece) > 2), F.decode(F.unhex(wide), "UTF-32"))
        .when(kind == "\\n", "\n").when(kind == "\\t", "\t").when(kind == "\\r", "\r")
        .otherwise(F.substring(piece, F.lit(2), F.length(piece)))
    )


def list_items(col: Column) -> Column:
    """Items of a list written as text, JSON's or a program's: ``['a', "l'eau", 'it\\'s', '']``. Text that is no list gives none."""

    def item(token: Column) -> Column:
        body = F.substring(token, F.lit(2), F.length(token) - 2)
        whole = F.array_join(F.transform(F.regexp_extract_all(body, F.lit(_ESCAPE), F.lit(0)), _unescaped), "")
        return F.when(F.substring(token, 1, 1).isin("'", '"'), whole).otherwise(F.trim(token))

    shown = F.trim(text(col))
    tokens = F.when(F.startswith(shown, F.lit("[")), F.regexp_extract_all(shown, F.lit(_ITEM), F.lit(0))).otherwise(F.array().cast(_STRINGS))
    return F.coalesce(F.from_json(F.when(F.startswith(shown, F.lit("[")), shown), _STRINGS, {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}), F.transform(tokens, item))


# ---- JSON-LD ----
ITEM_LIST = "struct<`@type`:string,itemListElement:array<struct<url:string,item:struct<url:string,`@id`:string>>>>"
JOB_POSTING = "struct<`@type`:string,title:string,datePosted:string,description:string,hiringOrganization:struct<name:string>,jobLocation:struct<address:struct<addressRegion:string,addressLocality:string>>>"


def jsonld_blocks(html: Column) -> Column:
    return F.regexp_extract_all(text(html), F.lit(r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))


def itemlist_urls(html: Column) -> Column:
    """http urls of the page's item lists, given as one object or a list of them."""
    def read(block: Column) -> Column:
        many = F.from_json(block, f"array<{ITEM_LIST}>")
        one = F.array(F.from_json(block, ITEM_LIST))
        return F.when(F.startswith(F.trim(block), F.lit("[")), many).otherwise(one)

    lists = F.flatten(F.transform(jsonld_blocks(html), read))
    items = F.flatten(F.transform(F.filter(lists, lambda x: x["itemListElement"].isNotNull()), lambda x: x["itemListElement"]))
    urls = F.transform(items, lambda x: F.coalesce(x["url"], x["item"]["url"], x["item"]["@id"]))
    return F.filter(urls, lambda x: F.startswith(x, F.lit("http")))


def parse_job_posting(html: Column) -> Column:
    """struct(title, date_posted, employer, region, locality, description) of the first JobPosting, or null."""
    posts = F.filter(F.transform(jsonld_blocks(html), lambda b: F.from_json(b, JOB_POSTING)), lambda x: x["@type"] == "JobPosting")
    x = F.try_element_at(posts, F.lit(1))
    return F.struct(
        x["title"].alias("title"), x["datePosted"].alias("date_posted"), x["hiringOrganization"]["name"].alias("employer"),
        x["jobLocation"]["address"]["addressRegion"].alias("region"), x["jobLocation"]["address"]["addressLocality"].alias("locality"), clean_text(x["description"]).alias("description"),
    )


