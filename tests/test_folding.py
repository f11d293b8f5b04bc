"""Folding against the Unicode database, character by character."""

import re
import sys
import unicodedata

from tenderloom.functions import text as tx


def plain(ch):
    kept = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
    return kept.lower()


def test_every_character_folds_as_the_unicode_database_says(spark):
    points = [chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF and unicodedata.category(chr(i)) not in ("Cn", "Co")]
    hangul = [c for c in points if 0xAC00 <= ord(c) <= 0xD7A3]
    points = [c for c in points if not 0xAC00 <= ord(c) <= 0xD7A3] + hangul[::97]
    rows = ["Ab" + "".join(points[i:i + 300]) + "Z" for i in range(0, len(points), 300)]
    got = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string").repartition(4).select("i", tx.fold_text("t").alias("f")).collect()
    for r in got:
        assert r.f == "".join(map(plain, rows[r.i])), r.i
    mixed = spark.createDataFrame([("Žluťoučký ŽLUŤ ǅ ﬁ ½ Σ각",), (None,), ("",), ("PLAIN",)], "t string")
    assert [r[0] for r in mixed.select(tx.fold_text("t")).collect()] == ["".join(map(plain, "Žluťoučký ŽLUŤ ǅ ﬁ ½ Σ각")), None, "", "plain"]


def test_latin_letters_are_folded_by_a_short_table(spark):
    # translate compares its tables at every call; the table of all characters is longer than any row
    latin = "".join(chr(i) for i in range(0x80, 0x250)) + "ßøđıæ" + "\u0250\u0391\u0416"
    row = spark.createDataFrame([(latin,)], "t string").select(tx.fold_text("t").alias("f"))
    assert row.first().f == "".join(map(plain, latin))
    short = [n for n in map(len, re.findall(r"translate\([^,]*, ([^,]*),", row._jdf.queryExecution().analyzed().toString())) if n < 1000]
    assert short
