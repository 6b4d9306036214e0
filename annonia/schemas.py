"""Declared columns of the five listing categories."""

from __future__ import annotations

from pyspark.sql import types as T

CONTACT = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("profile_link", T.StringType())]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in ("email", "phones", "whatsapp", "telegram", "viber")]
)

# ---- fixed values: field names by category; kinds: s text, d double, i int, a array of text, m months -> amount, c contact ----
FIELDS = {
    "immobilier": "titre url site_origine categorie category date_crawl prix prix_unit prix_value prix_dec:d description bien numero date_depot nombre_vues nb_pieces:i superficie superficie_unit papiers:a specifications:a images:a etage transaction payment:a adresse wilaya commune status:i contact:c as_photo date_verif as_prix",
    "voiture": "titre description numero nombre_vues date_depot site_origine categorie category images:a url annee marque model finition prix prix_unit prix_value prix_condition prix_dec:d adresse wilaya commune etat date_crawl status:i as_photo as_prix km km_unit moteur papers couleur options:a energie transmission contact:c",
    "emploi": "titre url site_origine categorie category date_crawl niveau:a diplome:a diplome_src:a numero date_depot nombre_vues transaction description employeur adresse wilaya commune status:i date_verif images:a as_photo as_prix vehicle prix prix_unit prix_value prix_dec:d contact:c",
    "electromenager": "titre url etat livraison site_origine transaction category categorie description date_depot marque modele garantie garantie_unit poid poid_unit couleur batterie capacite capacite_unit energie puissance puissance_unit prix_dec:d prix_unit images:a adresse status:i date_crawl date_verif as_photo as_prix contact:c par_facilite prix_facilite:m premier_versement premier_versement_value",
    "multimedia": "titre url etat livraison site_origine transaction category categorie description date_depot marque modele garantie garantie_unit dimension dimension_unit type_ecran taille_ecran taille_ecran_unit os os_version poid poid_unit couleur processor_cores processor_hz m_interne m_interne_unit ram ram_unit camera_ar camera_av batterie prix_dec:d prix_unit images:a adresse status:i date_crawl date_verif as_photo as_prix contact:c par_facilite prix_facilite:m premier_versement premier_versement_value",
}
# ---- end of fixed values ----

_KINDS = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "a": T.ArrayType(T.StringType()), "m": T.MapType(T.StringType(), T.DoubleType()), "c": CONTACT}


def schema(category: str) -> T.StructType:
    fields = (f.partition(":") for f in FIELDS[category].split())
    return T.StructType([T.StructField(n, _KINDS[k or "s"]) for n, _, k in fields])
