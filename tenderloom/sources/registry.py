"""Monthly national registry exports: JSON envelopes to tenders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import records as rec
from tenderloom.functions import text as tx
from tenderloom.schemas import REGISTRY_RECORD
from tenderloom.settings import Settings
from tenderloom.sources.order import in_file_order, number_of


def read_registry(spark: SparkSession, root: str, months: list[str]) -> DataFrame:
    """Records of the exports under ``root/month=YYYY-MM``, in the order of the months and files;
    only the asked months are listed and read.

    An export is one JSON envelope of any layout, possibly a single line, yet files are read in
    splits: the text source cuts them at the quoted name of the field that opens every record. (A
    quoted name inside a string has escaped quotes, so it is none.) What follows the name, up to the
    record's last brace, is parsed by itself; the rest of a piece is the frame around the records.
    Fields of a record that stand before that name would be lost, so such a file is an error.
    """
    paths = [f"{root}/month={m}" for m in months]
    name = f'"{fv.REGISTRY_RECORD_FIELD}"'
    pieces = in_file_order(spark.read.option("basePath", root).option("lineSep", name).text(paths), paths)
    value = F.col("value")
    # records of an array follow each other as ``},{"name"``: most pieces are told by their first and last character
    opens = F.when(value.startswith(":"), F.lit(True)).otherwise(value.rlike(r"^\s*:"))
    whole = F.when(value.endswith("{"), value).when(
        ~F.rtrim(F.regexp_replace("value", r"\s+$", "")).endswith(","), value).otherwise(
        F.raise_error(F.lit("a registry record has fields before " + name)))
    record = F.from_json(F.concat(F.lit("{" + name), whole), REGISTRY_RECORD)
    # a generator's row: conditions on the record stay above it, so that none of them parses the text again
    parsed = pieces.where(opens).select("month", "ord", F.explode(F.array(record)).alias("r"))
    return parsed.select("month", "r.*", "ord")


def normalize_registry(records: DataFrame) -> DataFrame:
    """Registry records (verejna_zakazka, historie_lhut) to the tender model.

    Records without id or title are dropped. Later months and later records have a
    higher ``ord``, so they win ties.
    """
    vz = F.col("verejna_zakazka")
    base = records.where(
        (F.coalesce(vz["identifikator_NIPEZ"], F.lit("")) != "")
        & (F.coalesce(vz["nazev_verejne_zakazky"], F.lit("")) != "")
    ).select(
        vz.alias("vz"), F.col("historie_lhut").alias("history"), rec.derive_lots(vz).alias("zps"),
        number_of(records).alias("ord"),
    )
    vz, zps = F.col("vz"), F.col("zps")
    nen = rec.first_where(
        vz["identifikatory_v_elektronickem_nastroji"], lambda i: i["kod_nastroje"] == "NEN"
    )["identifikator"]
    detail = rec.first_where(
        F.transform(zps, lambda z: z["odkaz_na_profil"]), lambda u: F.coalesce(u != "", F.lit(False))
    )
    parts = base.select(
        "vz", "ord", rec.derive_authority(vz).alias("a"), rec.derive_subject(vz).alias("s"),
        rec.derive_published_state_clar(zps).alias("p"), nen.alias("nen_id"), detail.alias("detail"),
        rec.derive_deadline(zps, F.col("history")).alias("deadline"), rec.derive_award(zps).alias("award"),
    )
    return parts.select(
        F.concat(F.lit("rvz:"), vz["identifikator_NIPEZ"]).alias("id"),
        F.lit(fv.REGISTRY_SOURCE).alias("source"), "ord", "nen_id",
        F.trim(vz["nazev_verejne_zakazky"]).alias("title"),
        "a.authority", "a.authority_ico", "s.cpv", "s.nuts", rec.derive_value(vz).alias("value"),
        "p.published", "deadline",
        rec.record_url(F.col("detail"), F.col("nen_id"), F.col("a.authority_profile")).alias("url"),
        "s.place", "a.authority_seat", "a.authority_profile", "p.state",
        F.lit(None).cast("string").alias("site_visit"), "p.clarifications",
        rec.derive_kind(vz["rezim_verejne_zakazky"]).alias("kind"), "award",
    )


def profiles_frame(spark: SparkSession, settings: Settings = Settings()) -> DataFrame:
    """The configured buyer profiles as a small dimension."""
    return spark.createDataFrame(
        [tuple(p) for p in settings.profiles],
        "key string, lat double, lon double, buyer string, ico string, profile_url string, agency boolean",
    )


def fill_urls(tenders: DataFrame, all_records: DataFrame, profiles: DataFrame) -> DataFrame:
    """Last resort for a link: the buyer's profile, configured or first seen in the run."""
    seen = (
        all_records.where((F.coalesce("authority_ico", F.lit("")) != "") & (F.coalesce("authority_profile", F.lit("")) != ""))
        .groupBy(F.col("authority_ico").alias("ico"))
        .agg(F.min_by("authority_profile", "ord").alias("seen_url"))
    )
    known = profiles.groupBy("ico").agg(F.max("profile_url").alias("own_url"))
    by_buyer = known.join(seen, "ico", "full").select(
        F.col("ico").alias("authority_ico"), F.coalesce("own_url", "seen_url").alias("_buyer_url")
    )
    return tenders.join(by_buyer, "authority_ico", "left").withColumn(
        "url", rec.with_scheme(F.coalesce(tx.blank_to_null("url"), "_buyer_url"))
    ).drop("_buyer_url").select(*tenders.columns)
