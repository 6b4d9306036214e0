"""Figures in text, with several spellings of each."""

import pytest
from pyspark.sql import functions as F

from annonia.functions import specs, vocab

CASES = [
    (specs.extract_capacity, "Capacité : 7.5 kg, 300 L", ("7.5", "kg")),
    (specs.extract_capacity, "frigo 300 Litres", ("300", "L")),
    (specs.extract_capacity, "capacity 20l", ("20", "L")),
    (specs.extract_capacity, "sans rien", ("", "")),
    (specs.extract_power, "Power: 2.2 KW", ("2.2", "KW")),
    (specs.extract_power, "1500 Watts", ("1500", "W")),
    (specs.extract_power, "500 W puissance : 900 w", ("900", "W")),
    (specs.extract_weight, "Poids : 900 g", ("900", "g")),
    (specs.extract_weight, "12.5 KG net", ("12.5", "kg")),
    (specs.extract_weight, "900 g", ("", "")),
    (specs.extract_ram, "RAM : 8 Go", ("8", "GB")),
    (specs.extract_ram, "16GB DDR4", ("16", "GB")),
    (specs.extract_ram, "32 GB RAM", ("32", "GB")),
    (specs.extract_ram, "512 GB SSD", ("", "")),
    (specs.extract_storage, "Storage : M.2 NVME 512 GB", ("512", "GB")),
    (specs.extract_storage, "1 TB SSD", ("1", "TB")),
    (specs.extract_storage, "256 gb nvme", ("256", "gb")),
    (specs.extract_storage, "Capacité (stockage) : 2 TB", ("2", "TB")),
    (specs.extract_storage, "8 GB RAM", ("", "")),
    (specs.extract_warranty, "Garantie : 24 Mois", ("24", "mois")),
    (specs.extract_warranty, "Warranty 1 Year", ("1", "ans")),
    (specs.extract_warranty, "garantie 2 سنة", ("2", "ans")),
    (specs.extract_warranty, "24 mois", ("", "")),
    (specs.extract_screen_size, "Taille de l'écran (pouces) : 15.6", "15.6"),
    (specs.extract_screen_size, '55" UHD', "55"),
    (specs.extract_screen_size, "6.5 inch", "6.5"),
    (specs.extract_screen_size, "32″", "32"),
    (specs.extract_camera, "Caméra arrière : 108 MP, selfie 32 Mégapixels", ("108", "32")),
    (specs.extract_camera, "front camera: 8MP", ("", "8")),
    (specs.extract_battery, "Batterie 5000 mAh", "5000"),
    (specs.extract_os, "android 13", ("Android", "13")),
    (specs.extract_os, "Chrome OS", ("Chrome OS", "")),
    (specs.extract_os, "iOS 17.2, Ubuntu", ("iOS", "17.2")),
    (specs.extract_dimensions, "60 x 55.5 × 85 cm", "60 x 55.5 x 85 cm"),
    (specs.extract_dimensions, "Dimensions : 60x55x85", "60 x 55 x 85 cm"),
    (specs.extract_dimensions, "600x550x850", ""),
    (specs.extract_processor, "CPU: Core i5 (2.4 GHz)", "Core i5 (2.4 GHz)"),
    (specs.extract_processor, "PC intel i7-12700KF, 16 GB", "intel i7-12700KF"),
    (specs.extract_processor, "Ryzen 5 5600X", "Ryzen 5 5600X"),
    (specs.extract_processor, "Core Ultra 7 155K", "Core Ultra 7 155K"),
    (specs.extract_processor, "Octa-Core", "Octa-Core"),
    (specs.screen_type, "tv qled", "QLED"),
    (specs.extract_energy_class, "classe A+++", "A+++"),
    (specs.extract_energy_class, "Classe C.", "C"),
    (vocab.suspicious_status, "Produits  chimiques", 404),
    (vocab.suspicious_status, "billets tachetés", 404),
    (vocab.suspicious_status, "un billetage propre", 200),
    (vocab.suspicious_status, "prix masqué, sièges tachetés", 200),
    (vocab.suspicious_status, "photos masquées", 404),
    (vocab.suspicious_status, "deux lavages", 200),
    (vocab.suspicious_status, "LAVAGE offert", 404),
]


@pytest.mark.parametrize("fn,given,want", CASES, ids=[f"{f.__name__}-{t[:18]}" for f, t, _ in CASES])
def test_figures(spark, fn, given, want):
    got = spark.createDataFrame([(given,)], "t string").select(fn(F.col("t")).alias("x")).first().x
    assert (tuple(got) if isinstance(want, tuple) else got) == want


def test_missing_text(spark):
    row = spark.createDataFrame([(None,)], "t string").select(*(f(F.col("t")).alias(f"c{k}") for k, f in enumerate({c[0] for c in CASES} - {vocab.suspicious_status}))).first()
    assert all(v == "" or set(v) <= {""} for v in row)
