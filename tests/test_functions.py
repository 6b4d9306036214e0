"""Hand-worked pairs for the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from annonia.functions import dates, money, pages, specs, vocab
from annonia.functions.base import number

AS_OF = F.to_date  # shorthand below


def one(spark, make, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    got = df.select(make(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first().x
    return tuple(got) if hasattr(got, "asDict") else got


CASES = [
    (pages.listing_id_from_url, ("https://x/annonce-d48254269",), "48254269"),
    (pages.listing_id_from_url, ("x/123",), "123"),
    (pages.listing_id_from_url, ("abc",), None),
    (pages.strip_extension, ("a/b.jpg.webp",), "a/b.jpg"),
    (pages.strip_extension, ("a/b",), "a/b"),
    (pages.strip_extension, ("a/.hidden",), "a/.hidden"),
    (money.traitement_prix, ("2.5", "Millions"), 25000.0),
    (money.traitement_prix, ("3", "Milliards"), 30000000.0),
    (money.traitement_prix, ("x", "Millions"), 0.0),
    (money.traitement_prix, ("5d", ""), 0.0),
    (money.parse_price, ("221", "Millions"), ("221 Millions", "221", 2210000.0, "Millions")),
    (money.parse_price, ("1 200 DA", None), ("1200", "1200", 1200.0, "DA")),
    (money.parse_price, ("1.200.000", None), ("1.200.000", "1.200.000", 0.0, "DA")),
    (money.parse_price, ("", "x"), ("", "", 0.0, "DA")),
    (money.parse_price, (None, None), ("", "", 0.0, "DA")),
    (money.vehicle_price, ("1.200.000", "DA"), 1200000.0),
    (money.vehicle_price, ("1,5", "Millions"), 15000.0),
    (money.vehicle_price, ("14500", "EUR"), 14500.0),
    (money.process_price, ("12 500,00 DA",), 12500.0),
    (money.process_price, ("n/a",), 0.0),
    (money.process_price, ("12 500 DZD",), 12500.0),
    (money.extract_salary, ("salaire 50 000 DA net",), ("50000", "DA")),
    (money.extract_salary, ("",), ("", "")),
    (money.extract_salary_range, ("30 000 - 50 000 DA",), ("30000-50000", "DA", "Avec prix")),
    (money.extract_salary_range, ("50 000 da",), ("50000", "DA", "Avec prix")),
    (money.normalize_mileage, ("120 000 km",), ("120000", "KM")),
    (money.normalize_mileage, ("80 miles",), ("80", "Miles")),
    (money.extract_engine_size, ("1.8L",), 1.8),
    (money.extract_engine_size, ("1800cc",), 1.8),
    (money.extract_engine_size, ("1.6 TSI",), 1.6),
    (money.extract_engine_size, ("",), 0.0),
    (money.normalize_pieces, ("F3",), 3),
    (money.normalize_pieces, ("3 pièces",), 3),
    (money.normalize_pieces, ("",), None),
    (money.extract_etage_number, ("R+2",), "3"),
    (money.extract_etage_number, ("Immeuble de 5 étages",), "5"),
    (money.extract_etage_number, ("x",), ""),
    (vocab.normalize_fuel, ("Petrol",), "Essence"),
    (vocab.normalize_fuel, ("essence gpl pack",), "GPL"),
    (vocab.normalize_fuel, ("hydrogene",), "Multi-énergie"),
    (vocab.normalize_fuel, ("Électrique",), "Multi-énergie"),
    (lambda c: vocab.normalize_fuel(c, fold=True), ("Électrique",), "Electrique"),
    (vocab.normalize_fuel, (None,), ""),
    (vocab.normalize_transmission, ("dct",), "Automatique"),
    (vocab.normalize_transmission, ("Semi auto",), "Semi-Automatique"),
    (vocab.normalize_transmission, ("MT",), "Manuelle"),
    (vocab.normalize_transmission, ("BV6",), "BV6"),
    (vocab.convert_property_type, ("appartements",), "Appartement"),
    (vocab.convert_property_type, ("villa avec jardin",), "Villa"),
    (vocab.convert_property_type, ("niveau",), "Niveau de villa"),
    (vocab.convert_property_type, ("xyz",), ""),
    (vocab.detect_transaction, ("Location vacances mer",), "Location-vacances"),
    (vocab.detect_transaction, ("Cherche achat villa",), "Cherche-achat"),
    (vocab.detect_transaction, ("Vente F3",), "Vente"),
    (vocab.normalize_diplome, ("Doctorat",), "Doctorat"),
    (vocab.normalize_diplome, ("sans diplôme",), None),
    (vocab.normalize_diplome, ("CAP",), "CAP"),
    (vocab.extract_wilaya, ("Alger, Hydra",), "Alger"),
    (vocab.extract_wilaya, ("",), "Télétravail"),
    (specs.extract_warranty, ("Garantie: 2 ans",), ("2", "ans")),
    (specs.extract_warranty, ("Warranty 6 months",), ("6", "mois")),
    (specs.extract_warranty, ("Garantie 1",), ("1", "ans")),
    (specs.extract_os, ("Windows 11 Pro",), ("Windows", "11")),
    (specs.extract_os, ("Ubuntu",), ("Ubuntu", "")),
    (specs.extract_energy_class, ("Classe A++",), "A++"),
    (specs.extract_energy_class, ("a la carte",), ""),
    (dates.parse_date, ("31/12/2024",), "2024-12-31T00:00:00"),
    (dates.parse_date, ("Date",), ""),
    (dates.parse_date, ("x",), ""),
    (dates.parse_date, ("31/02/2024",), ""),
    (pages.best_srcset, ("a 1w, b 2w",), "b"),
    (pages.normalize_image_url, ("http://x/a-500x500.jpg.jpg",), "https://x/a.jpg"),
]


@pytest.mark.parametrize("make,values,expected", CASES, ids=[str(i) for i in range(len(CASES))])
def test_pairs(spark, make, values, expected):
    assert one(spark, make, *values) == expected


@pytest.mark.parametrize(
    "text,expected",
    [("il y a 3 jours", "2026-01-12"), ("il y a 2 mois", "2025-11-16"), ("Hier", "2026-01-14"), ("bientôt", "bientôt"), ("2025-03-04T10:00:00", "2025-03-04"), ("4 Apr-10:24", "2026-04-04"), ("12 mars 2023", "2023-03-12"), ("31 février 2023", "31 février 2023")],
)
def test_normalize_date(spark, text, expected):
    as_of = F.lit(dt.date(2026, 1, 15))
    assert one(spark, lambda c: dates.normalize_date(c, as_of), text) == expected


def test_phones(spark):
    html = '<a href="tel:+213 550-12-34-56">x</a><a href="tel:1234">y</a>'
    assert one(spark, lambda h: pages.extract_phones(h, F.lit("appel 066 12 23 34")), html) == ["213550123456", "066122334"]


def test_blocked(spark):
    df = spark.createDataFrame([(403, ""), (200, "Access Denied"), (200, "ok"), (None, None)], "s int, h string")
    assert [r.x for r in df.select(pages.is_blocked(F.col("s"), F.col("h")).alias("x")).collect()] == [True, True, False, False]


def test_number_is_guarded(spark):
    df = spark.createDataFrame([("5d",), ("NaN",), (" 1.5 ",), ("1e3",), ("",), (None,)], "c string")
    assert [r.x for r in df.select(number(F.col("c")).alias("x")).collect()] == [None, None, 1.5, 1000.0, None, None]
