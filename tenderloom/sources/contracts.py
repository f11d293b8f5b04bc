"""Monthly dumps of the public contract registry: XML to flat contract rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx
from tenderloom.schemas import CONTRACT_RECORD
from tenderloom.sources.order import in_file_order, number_of


def read_contract_xml(spark: SparkSession, path: str) -> DataFrame:
    """The XML source splits a dump by record; only the declared fields are read. Records keep the
    order of the dump in ``ord``."""
    scan = (
        spark.read.format("xml").schema(CONTRACT_RECORD).option("rowTag", fv.CONTRACT_ROW_TAG)
        .option("ignoreNamespace", True).load(path)
    )
    return in_file_order(scan, [path])


def normalize_contracts(records: DataFrame) -> DataFrame:
    """Flat rows; a record without identifier or body is skipped, an unreadable value NULL."""
    body, ident = F.col("smlouva"), F.col("identifikator")
    blank = F.lit("")
    value = F.trim(body["hodnotaBezDph"]).try_cast("double")
    return records.where(body.isNotNull() & ident.isNotNull()).select(
        F.trim(ident["idSmlouvy"]).alias("id"), F.trim(ident["idVerze"]).alias("verze"),
        F.trim("odkaz").alias("url"),
        (F.coalesce(F.trim("platnyZaznam"), blank) != "0").alias("platny"),
        F.coalesce(F.trim(body["subjekt"]["ico"]), blank).alias("ico_zadavatel"),
        F.transform(body["smluvniStrana"], lambda s: F.struct(
            tx.blank_to_null(s["ico"]).alias("ico"), tx.blank_to_null(s["nazev"]).alias("nazev")
        )).alias("parties"),
        F.trim(body["predmet"]).alias("predmet"), F.trim(body["datumUzavreni"]).alias("datum"),
        F.when(~F.isnan(value), value).alias("hodnota"),
        tx.blank_to_null(body["navazanyZaznam"]).alias("parent"),
        number_of(records).alias("ord"),
    )
