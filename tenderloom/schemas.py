"""Explicit schemas of inputs and stored tables, as DDL column lists."""

from pyspark.sql import types as T

_SUBJECT = "struct<nazev_subjektu:string,ico:string,sidlo:string>"
_OBJECT = (
    "struct<hlavni_kod_CPV:string,vedlejsi_kod_CPV:array<string>,mista_plneni:array<struct<"
    "nuts:string,misto_plneni_jine:string,dalsi_informace_o_miste_plneni:string>>>"
)
_CONTRACT = (
    "struct<hodnota_smluvni_ceny_mena:string,hodnota_smluvni_ceny_bez_DPH:double,"
    "skutecne_uhrazene_ceny:array<struct<mena:string,hodnota_skutecne_uhrazene_ceny_bez_DPH:double>>,"
    "datum_uzavreni_smlouvy:string,"
    f"dodavatele_se_kterymi_byla_uzavrena_smlouva:array<struct<subjekt:{_SUBJECT}>>>"
)
_PROCEDURE = (
    "struct<stav:string,odkaz_na_profil:string,datum_zahajeni_zadavaciho_postupu:string,"
    "pocet_zaslanych_zaevidovanych_vysvetleni_zadavaci_dokumentace:int,"
    "lhuty:array<struct<druh_lhuty:string,aktivni:boolean,datum_a_cas_konce_lhuty:string>>,"
    f"vysledek:struct<smlouva:array<{_CONTRACT}>,"
    f"vybrani_dodavatele_zadavaciho_postupu:array<struct<subjekt:{_SUBJECT}>>>>"
)
REGISTRY_RECORD = (
    "verejna_zakazka struct<identifikator_NIPEZ:string,nazev_verejne_zakazky:string,"
    "rezim_verejne_zakazky:string,predpokladana_hodnota_bez_DPH_v_CZK:double,"
    "predpokladana_hodnota_bez_DPH:double,predpokladana_hodnota_bez_DPH_mena:string,"
    "identifikatory_v_elektronickem_nastroji:array<struct<identifikator:string,kod_nastroje:string>>,"
    f"predmet:{_OBJECT},"
    "casti_verejne_zakazky:array<struct<"
    f"predmet:{_OBJECT},predpokladana_hodnota_casti_bez_DPH_v_CZK:double,zadavaci_postup_pro_cast:{_PROCEDURE}>>,"
    "zadavaci_postupy:array<struct<zadavatel_zadavaciho_postupu:struct<zadavatele:array<struct<"
    f"zadava_zadavaci_postup:boolean,adresa_profilu:string,subjekt:{_SUBJECT}>>>,"
    f"zadavaci_postupy_pro_casti:array<{_PROCEDURE}>>>>,"
    "historie_lhut array<struct<zaznamy:array<struct<druh_lhuty:string,datum_a_cas_konce_lhuty:string>>>>"
)

CONTRACT_RECORD = (
    "identifikator struct<idSmlouvy:string,idVerze:string>,odkaz string,platnyZaznam string,"
    "smlouva struct<subjekt:struct<ico:string>,smluvniStrana:array<struct<ico:string,nazev:string>>,"
    "predmet:string,datumUzavreni:string,hodnotaBezDph:string,navazanyZaznam:string>"
)
_BIDDER_XML = "struct<nazev_subjektu:string,ico:string,nabidkova_cena_bez_dph:string,ucastnik_vyloucen:string>"
PROFILE_RECORD = (
    "id_objektu string,id_nipez string,nazev_vz string,rezim_vz string,hlavni_cpv string,"
    "casti_vz struct<cast_zakazky:array<struct<hlavni_cpv_casti_vz:string,zadavaci_postup_casti:struct<"
    "stav_zadavaciho_postupu:string,datum_uverejneni:string,"
    "lhuty_zadavaciho_postupu:struct<lhuta:array<struct<druh_lhuty:string,datum_konce_lhuty:string>>>,"
    f"ucastnici:struct<ucastnik:array<{_BIDDER_XML}>>,"
    "vybrany_dodavatel:struct<nazev_subjektu:string,ico:string,smluvni_cena_bez_dph:string>,"
    "datum_uzavreni_smlouvy:string,url_v_registru_smluv:string,"
    "dokumenty:struct<dokument:array<struct<typ_dokumentu:string,url:string>>>>>>>"
)
FEED_ITEM = (
    "link string"
)
GAZETTEER = (
    "name string,lat double,lon double"
)

TENDER = (
    "id string,source string,ord long,nen_id string,title string,authority string,authority_ico string,"
    "cpv array<string>,nuts array<string>,value double,published string,deadline string,url string,"
    "place string,authority_seat string,authority_profile string,state string,site_visit string,"
    "clarifications int,kind string,"
    "award struct<date:string,winner:string,winner_ico:string,price_contracted:double,price_paid:double,registr_url:string>,"
    "bidders array<struct<nazev:string,ico:string,cena:double,vyloucen:boolean>>,"
    "profile_url string,kw_match boolean,no_nuts boolean,no_value boolean,expired boolean,dist_km int,"
    "loc_unknown boolean,url_dead int,link_dead boolean,auto_expired date,no_activity boolean"
)
CHANGE = (
    "id string,date date,field string,label string,old string,new string,seq int"
)
LINK = (
    "tender_id string,contract_id string,url string,date date,price double,confidence string"
)
CONTRACT = (
    "id string,verze string,url string,platny boolean,ico_zadavatel string,"
    "parties array<struct<ico:string,nazev:string>>,predmet string,datum string,hodnota double,"
    "parent string,ord long"
)
WATCHED = (
    "id string,contract_id string,url string,date date,price double,supplier string"
)
AMENDMENT = (
    "contract_id string,amendment_id string,date string,value double,url string,ord long"
)
VERDICT = (
    "id string,verdikt string,duvod string"
)
PREFERENCE = (
    "kind string,id string,ts long,on boolean,"
    "fp struct<cpv:array<string>,ico:string,toks:array<string>,title:string>"
)


def part_of(schema: str, *paths: str) -> T.StructType:
    """The fields of a schema that the dotted paths name, with all that is below them, in its order;
    arrays are passed through."""
    def chosen(kind: T.DataType, wanted: list[list[str]]) -> T.DataType:
        if [] in wanted:
            return kind
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(chosen(kind.elementType, wanted), kind.containsNull)
        below = {f.name: [w[1:] for w in wanted if w[0] == f.name] for f in kind.fields}
        missing = {w[0] for w in wanted} - set(below)
        if missing:
            raise ValueError(f"no such field: {sorted(missing)}")
        return T.StructType([T.StructField(f.name, chosen(f.dataType, below[f.name]), f.nullable) for f in kind.fields if below[f.name]])

    return chosen(T.StructType.fromDDL(schema), [p.split(".") for p in paths])
