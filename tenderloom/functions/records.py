"""Derivations over nested procurement records, as Columns (no explode, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv
from tenderloom.functions import text as tx


def _array(c: Column, kind: str = "string") -> Column:
    return F.coalesce(c, F.array().cast(f"array<{kind}>"))


def _texts(values: Column) -> Column:
    """Trimmed non-empty strings, first occurrence kept."""
    trimmed = F.transform(values, lambda x: F.trim(x.cast("string")))
    return _array(F.array_distinct(F.filter(trimmed, lambda x: F.coalesce(x != "", F.lit(False)))))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: the variable of a lambda over one element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def first_where(values: Column, condition) -> Column:
    return F.get(F.filter(values, condition), F.lit(0))


def derive_lots(vz: Column) -> Column:
    """Procedures of the lots; without any, those listed under the procedures."""
    own = F.filter(
        F.transform(vz["casti_verejne_zakazky"], lambda c: c["zadavaci_postup_pro_cast"]), lambda z: z.isNotNull()
    )
    listed = F.filter(
        F.flatten(F.filter(
            F.transform(vz["zadavaci_postupy"], lambda p: p["zadavaci_postupy_pro_casti"]), lambda a: a.isNotNull()
        )),
        lambda z: z.isNotNull(),
    )
    return F.when(F.size(own) > 0, own).otherwise(listed)


def derive_authority(vz: Column) -> Column:
    """Buyer of the first procedure that has one: the awarding one, else the first."""
    buyers = first_where(
        F.transform(vz["zadavaci_postupy"], lambda p: p["zadavatel_zadavaciho_postupu"]["zadavatele"]),
        lambda b: F.coalesce(F.size(b) > 0, F.lit(False)),
    )
    awarding = first_where(buyers, lambda b: F.coalesce(b["zadava_zadavaci_postup"], F.lit(False)))
    chosen = F.coalesce(awarding, F.get(buyers, F.lit(0)))
    subject = chosen["subjekt"]
    return F.struct(
        tx.blank_to_null(subject["nazev_subjektu"]).alias("authority"),
        tx.blank_to_null(subject["ico"]).alias("authority_ico"),
        tx.blank_to_null(subject["sidlo"]).alias("authority_seat"),
        tx.blank_to_null(chosen["adresa_profilu"]).alias("authority_profile"),
    )


def derive_subject(vz: Column) -> Column:
    """CPV codes, regions and place text of the tender and all lots, in order, unique."""
    subjects = F.concat(
        F.array(vz["predmet"]),
        F.coalesce(F.transform(vz["casti_verejne_zakazky"], lambda c: c["predmet"]),
                   F.filter(F.array(vz["predmet"]), lambda _: F.lit(False))),
    )
    cpv = F.flatten(F.transform(
        subjects, lambda p: F.concat(F.array(p["hlavni_kod_CPV"]), _array(p["vedlejsi_kod_CPV"]))
    ))
    places = F.flatten(F.filter(
        F.transform(subjects, lambda p: p["mista_plneni"]), lambda m: m.isNotNull()
    ))
    nuts = F.transform(places, lambda m: m["nuts"])
    words = F.flatten(F.transform(
        places, lambda m: F.array(m["misto_plneni_jine"], m["dalsi_informace_o_miste_plneni"])
    ))
    return F.struct(
        _texts(cpv).alias("cpv"), _texts(nuts).alias("nuts"),
        F.nullif(F.array_join(_texts(words), "; "), F.lit("")).alias("place"),
    )


def derive_value(vz: Column) -> Column:
    """Value in the home currency, else the sum of lots when every lot has one."""
    home = F.coalesce(vz["predpokladana_hodnota_bez_DPH_mena"] == "CZK", F.lit(True))
    lots = F.transform(vz["casti_verejne_zakazky"], lambda c: c["predpokladana_hodnota_casti_bez_DPH_v_CZK"])
    complete = (F.size(lots) > 0) & F.forall(lots, lambda v: v.isNotNull())
    total = F.aggregate(lots, F.lit(0.0), lambda a, v: a + v)
    return F.coalesce(
        vz["predpokladana_hodnota_bez_DPH_v_CZK"],
        F.when(home, vz["predpokladana_hodnota_bez_DPH"]),
        F.when(complete, total),
    )


def _sum_known(values: Column) -> Column:
    """Sum of the known values, NULL when none is known."""
    known = F.filter(values, lambda v: v.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, v: a + v))


def _is_home(currency: Column) -> Column:
    return F.coalesce(currency == "CZK", F.lit(True))


def _flat(arrays: Column) -> Column:
    return F.flatten(F.filter(arrays, lambda a: a.isNotNull()))


def derive_award(zps: Column) -> Column:
    """Result over the contracts of all lots; NULL when there is none.

    Prices add up over contracts, paid amounts over years, home currency only. Winners
    come from the contracts, else from the selection decision.
    """
    contracts = _flat(F.transform(zps, lambda z: z["vysledek"]["smlouva"]))
    selected = _flat(F.transform(zps, lambda z: z["vysledek"]["vybrani_dodavatele_zadavaciho_postupu"]))
    names = lambda a: _texts(F.transform(a, lambda d: d["subjekt"]["nazev_subjektu"]))
    ids = lambda a: _texts(F.transform(a, lambda d: d["subjekt"]["ico"]))

    def winners(suppliers: Column) -> Column:
        """(names, ids) of the contracts' suppliers; the selection fills in when they have no names."""
        named = F.struct(names(suppliers).alias("names"), ids(suppliers).alias("ids"))
        return _let(named, lambda w: F.when(F.size(w["names"]) > 0, w).otherwise(_let(selected, lambda d: F.struct(
            names(d).alias("names"), F.array_union(w["ids"], ids(d)).alias("ids")))))

    def award(c: Column) -> Column:
        suppliers = _flat(F.transform(c, lambda s: s["dodavatele_se_kterymi_byla_uzavrena_smlouva"]))
        home = F.filter(c, lambda s: _is_home(s["hodnota_smluvni_ceny_mena"]))
        payments = F.filter(
            _flat(F.transform(c, lambda s: s["skutecne_uhrazene_ceny"])), lambda u: _is_home(u["mena"])
        )
        dates = _texts(F.transform(c, lambda s: F.substring(s["datum_uzavreni_smlouvy"], 1, 10)))
        return _let(_let(suppliers, winners), lambda w: F.struct(
            F.array_max(dates).alias("date"),
            F.array_join(w["names"], "; ").alias("winner"),
            F.array_join(w["ids"], "; ").alias("winner_ico"),
            _let(F.transform(home, lambda s: s["hodnota_smluvni_ceny_bez_DPH"]), _sum_known).alias("price_contracted"),
            _let(F.transform(payments, lambda u: u["hodnota_skutecne_uhrazene_ceny_bez_DPH"]), _sum_known).alias("price_paid"),
            F.lit(None).cast("string").alias("registr_url"),
        ))

    return _let(contracts, lambda c: F.when(F.size(c) > 0, award(c)))


def _latest_end(terms: Column, condition) -> Column:
    ends = F.transform(F.filter(terms, condition), lambda t: F.nullif(t["datum_a_cas_konce_lhuty"], F.lit("")))
    return F.substring(F.array_max(ends), 1, 19)


def derive_deadline(zps: Column, history: Column) -> Column:
    """First kind of deadline that is present, active entries before any; then history."""
    terms = _flat(F.transform(zps, lambda z: z["lhuty"]))
    past = _flat(F.transform(history, lambda h: h["zaznamy"]))
    def of_kind(kind: str):
        return lambda t: t["druh_lhuty"] == kind

    def active(kind: str):
        return lambda t: (t["druh_lhuty"] == kind) & F.coalesce(t["aktivni"], F.lit(False))

    tiers = [
        _latest_end(terms, choose(kind)) for kind in fv.DEADLINE_KINDS for choose in (active, of_kind)
    ] + [_latest_end(past, of_kind(kind)) for kind in fv.DEADLINE_KINDS]
    return F.coalesce(*tiers)


def derive_deadline_profile(terms: Column) -> Column:
    """Latest end of a bid deadline in a profile export (struct druh_lhuty, datum_konce_lhuty)."""
    bids = F.filter(terms, lambda t: tx.fold_text(t["druh_lhuty"]).rlike(fv.PROFILE_DEADLINE_PATTERN))
    ends = F.transform(bids, lambda t: tx.blank_to_null(t["datum_konce_lhuty"]))
    return F.substring(F.array_max(ends), 1, 19)


def derive_published_state_clar(zps: Column) -> Column:
    """Earliest start, first state and number of clarifications over the lots."""
    starts = F.transform(
        zps, lambda z: F.substring(F.nullif(z["datum_zahajeni_zadavaciho_postupu"], F.lit("")), 1, 10)
    )
    counts = F.transform(
        zps, lambda z: F.coalesce(z["pocet_zaslanych_zaevidovanych_vysvetleni_zadavaci_dokumentace"], F.lit(0))
    )
    return F.struct(
        F.array_min(starts).alias("published"),
        first_where(F.transform(zps, lambda z: z["stav"]), lambda s: F.coalesce(s != "", F.lit(False))).alias("state"),
        F.aggregate(counts, F.lit(0), lambda a, v: a + v).alias("clarifications"),
    )


def derive_kind(regime: Column) -> Column:
    small = F.coalesce(regime == fv.SMALL_SCALE_REGIME, F.lit(False))
    return F.when(small, "VZMR").otherwise("VZ")


def derive_kind_profile(regime: Column) -> Column:
    """A profile record without a (folded) regime counts as small scale."""
    large = F.coalesce((regime != "") & ~regime.contains("maleho rozsahu"), F.lit(False))
    return F.when(large, "VZ").otherwise("VZMR")


def derive_bidders(participants: Column) -> Column:
    """Bidders with price and exclusion; NULL when nobody is listed."""
    rows = F.transform(participants, lambda u: F.struct(
        F.coalesce(F.trim(u["nazev_subjektu"]), F.lit("")).alias("nazev"),
        F.coalesce(F.trim(u["ico"]), F.lit("")).alias("ico"),
        u["nabidkova_cena_bez_dph"].try_cast("double").alias("cena"),
        F.coalesce(F.trim(u["ucastnik_vyloucen"]) == "1", F.lit(False)).alias("vyloucen"),
    ))
    return F.when(F.size(rows) > 0, rows)


def derive_profile_award(supplier: Column, signed: Column, registry_url: Column) -> Column:
    """Award of a profile record: needs a selected supplier and a signature date."""
    day = F.substring(tx.blank_to_null(signed), 1, 10)
    return F.when(supplier.isNotNull() & day.isNotNull(), F.struct(
        day.alias("date"),
        F.coalesce(F.trim(supplier["nazev_subjektu"]), F.lit("")).alias("winner"),
        F.coalesce(F.trim(supplier["ico"]), F.lit("")).alias("winner_ico"),
        supplier["smluvni_cena_bez_dph"].try_cast("double").alias("price_contracted"),
        F.lit(None).cast("double").alias("price_paid"),
        tx.blank_to_null(registry_url).alias("registr_url"),
    ))


def platform_url(platform_id: Column) -> Column:
    return F.concat(F.lit(fv.PLATFORM_DETAIL_URL), F.replace(platform_id, F.lit("/"), F.lit("-")))


def record_url(detail: Column, platform_id: Column, profile: Column) -> Column:
    """Link to the detail, else to the platform page of its id, else to the profile."""
    by_id = F.when(platform_id.contains("/"), platform_url(platform_id))
    return F.coalesce(tx.blank_to_null(detail), by_id, profile)


def with_scheme(url: Column) -> Column:
    return F.when(url.rlike("^https?://"), url).otherwise(F.concat(F.lit("https://"), url))
