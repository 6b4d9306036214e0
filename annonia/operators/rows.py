"""Row rules: projection to the declared columns, validity, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import base, dates, money, pages, vocab


def _declared(df: DataFrame, category: str) -> list[Column]:
    out = []
    for f in schemas.schema(category).fields:
        if f.name in df.columns:
            out.append(df[f.name].cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.lit("").alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            out.append(F.array().cast(f.dataType).alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return out


def conform(df: DataFrame, category: str) -> DataFrame:
    """The category's declared columns in order; absent ones get their default, extra ones go."""
    return df.select(*_declared(df, category))


def conform_open(df: DataFrame, category: str) -> DataFrame:
    """As ``conform``, with what doesn't fit kept: ``rejected``, the texts of values that their declared type can't hold, by column, and
    ``other_information``, the columns that aren't declared, as a variant (``try_variant_get`` reads them with a type)."""
    declared = {f.name: f.dataType for f in schemas.schema(category).fields}
    atomic = [n for n, t in declared.items() if n in df.columns and not isinstance(t, (T.ArrayType, T.MapType, T.StructType))]
    lost = [F.struct(F.lit(n).alias("key"), F.when(df[n].try_cast(declared[n]).isNull(), df[n].cast("string")).alias("value")) for n in atomic]
    rejected = F.map_from_entries(F.filter(F.array(*lost), lambda x: x["value"].isNotNull())) if lost else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    others = [c for c in df.columns if c not in declared]
    other = F.parse_json(F.to_json(F.struct(*(df[c] for c in others)))) if others else F.parse_json(F.lit("{}"))
    kept = df.withColumns({"_rejected": rejected, "_other": other} | {n: df[n].try_cast(declared[n]) for n in atomic})
    return kept.select(*_declared(kept, category), F.col("_rejected").alias("rejected"), F.col("_other").alias("other_information"))


def unify_vehicle(df: DataFrame) -> DataFrame:
    """Standard columns of a vehicle listing from raw text columns."""
    return df.withColumns(
        {
            "titre": vocab.format_title(F.col("titre")),
            "marque": vocab.format_title(F.col("marque")),
            "model": vocab.format_title(F.col("model")),
            "annee": money.normalize_year(F.col("annee")),
            "km": money.normalize_km(F.col("km")),
            "prix_dec": money.vehicle_price(F.col("prix"), F.col("prix_unit")),
            "export": money.export_flag(F.col("prix_unit")),
            "energie": vocab.normalize_energie_exact(F.col("energie")),
            "transmission": vocab.normalize_transmission(F.col("transmission")),
        }
    )


def drop_empty_essential(df: DataFrame, column: str = "titre") -> DataFrame:
    return df.where(~base.blank(F.col(column)))


def is_complete(required: list[str]) -> Column:
    out = F.lit(True)
    for c in required:
        out = out & F.col(c).isNotNull()
    return out


def importable_vehicles(df: DataFrame, fuel: str = "energie", litres: str = "cylindree") -> DataFrame:
    """No diesel; petrol up to 1.8 litres."""
    f, size = base.text(F.col(fuel)), F.coalesce(F.col(litres), F.lit(0.0))
    return df.where((f != "Diesel") & ~((f == "Essence") & (size > 1.8)))


def recent_vehicles(df: DataFrame, as_of: Column, years: int = 3, column: str = "annee") -> DataFrame:
    return df.where(F.coalesce(F.col(column).cast("string").try_cast("int") >= F.year(as_of) - years, F.lit(False)))


def fill_nulls(df: DataFrame) -> DataFrame:
    """Null text becomes '', null arrays become empty."""
    def filled(f):
        if isinstance(f.dataType, T.StringType):
            return F.coalesce(f.name, F.lit("")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.coalesce(f.name, F.array().cast(f.dataType)).alias(f.name)
        return F.col(f.name)

    return df.select(*(filled(f) for f in df.schema.fields))


def add_crawl_metadata(df: DataFrame, as_of: Column) -> DataFrame:
    old = F.col("date_crawl") if "date_crawl" in df.columns else F.lit(None)
    return df.withColumn("date_crawl", F.coalesce(old.cast("string"), F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss")))


def doc_id(url: Column, numero: Column, category: Column, *rest: Column) -> Column:
    """Url, else number, else a hash of the row, so that it repeats."""
    made = F.concat(base.text(category), F.lit("-"), F.lower(F.hex(F.xxhash64(*(rest or (url, numero, category))))))
    return F.coalesce(base.some(base.text(url)), base.some(base.text(numero)), made)


def version_id(url: Column, date_crawl: Column) -> Column:
    return F.concat_ws("|", base.text(url), base.text(date_crawl.cast("string")))


def composite_numero(ref: Column, brand: Column, model: Column, price: Column) -> Column:
    joined = F.concat_ws("_", base.text(brand), base.text(model), base.text(price))
    return F.when(base.text(ref) != "", F.concat_ws("_", ref, base.text(price))).otherwise(F.replace(joined, F.lit(" "), F.lit("_")))


def default_year(annee: Column, as_of: Column) -> Column:
    return F.coalesce(base.some(base.text(annee)), (F.year(as_of) - 3).cast("string"))


def format_job_record(df: DataFrame) -> DataFrame:
    """Raw scrape -> job record: cleaned text, one-element lists, flags."""
    return df.select(
        pages.clean_text(F.col("title")).alias("titre"),
        F.col("url"),
        pages.clean_text(F.col("description")).alias("description"),
        F.array(vocab.normalize_diplome(F.col("diploma"))).alias("diplome"),
        dates.parse_date(F.col("posted")).alias("date_depot"),
        money.extract_salary(F.col("salary"))["amount"].alias("prix"),
        money.avec_sans_prix(money.extract_salary(F.col("salary"))["amount"], money.extract_salary(F.col("salary"))["unit"]).alias("as_prix"),
    )


def format_tv_record(df: DataFrame) -> DataFrame:
    images = pages.clean_images(F.transform("images", pages.normalize_image_url))
    return df.select(
        pages.clean_text(F.col("title")).alias("titre"),
        F.col("url"),
        money.process_price(F.col("price")).alias("prix_dec"),
        money.avec_sans_prix(money.process_price(F.col("price")), F.lit("DA")).alias("as_prix"),
        images.alias("images"),
        money.avec_sans_photo(images).alias("as_photo"),
    )
