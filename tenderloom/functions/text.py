"""Text and number scalars as Columns (all JVM-side, no Python per row)."""

from __future__ import annotations

import html.entities
import unicodedata
from functools import cache, lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenderloom import fixed_values as fv

def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Missing means NULL: trim, and turn the empty string into NULL."""
    return F.nullif(F.trim(col(c)), F.lit(""))


_HANGUL = (0xAC00, 0xD7A3)      # syllables, which decompose by arithmetic
_LATIN_END = "\u0250"            # Latin letters and their signs stand before it


def _ranges(points: list[int]) -> str:
    """Characters as the inside of a regular expression's class."""
    out: list[list[int]] = []
    for i in points:
        if out and i == out[-1][1] + 1:
            out[-1][1] = i
        else:
            out.append([i, i])
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out)


@lru_cache(maxsize=2)
def _folding(all_marks: bool) -> tuple[str, str, dict[str, str], str, str]:
    """Single characters and what they become, expanding characters, and the classes of the
    expanding ones and of dropped marks: every character of the Unicode database."""
    source, target, many, dropped = [], [], {}, []
    for i in (*range(0x41, 0x5B), *range(0x80, 0x110000)):
        if 0xD800 <= i <= 0xDFFF or _HANGUL[0] <= i <= _HANGUL[1]:
            continue
        parts = unicodedata.normalize("NFKD", chr(i))
        kept = "".join(x for x in parts if not (unicodedata.combining(x) if all_marks else 0x300 <= ord(x) <= 0x36F)).lower()
        if kept == chr(i):
            continue
        if len(kept) == 1:
            source.append(chr(i))
            target.append(kept)
        elif kept:
            many[chr(i)] = kept
        else:
            dropped.append(i)
    return "".join(source), "".join(target), many, _ranges([ord(c) for c in many]), _ranges(dropped)


def _char(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _jamo(syllable: Column) -> Column:
    """Letters of a Hangul syllable: 19 leading, 21 vowels, and 27 trailing or none."""
    s = F.ascii(syllable) - _HANGUL[0]
    last = F.pmod(s, F.lit(28))
    return F.concat(
        _char(F.floor(s / 588) + 0x1100), _char(F.floor(F.pmod(s, F.lit(588)) / 28) + 0x1161),
        F.when(last > 0, _char(last + 0x11A7)).otherwise(""),
    )


def _fold(c: Column | str, all_marks: bool) -> Column:
    """Spark has no Unicode normalisation function, so decomposition and lower-casing are a table
    computed from the Unicode database. Plain ASCII rows need only ``lower``. The others are few
    characters often repeated: each distinct one that is not ASCII is folded once, by itself, and
    replaced wherever it stands. (What a character folds to folds to itself, so the order of the
    replacements does not matter, and ``lower`` then meets upper case in ASCII only.)"""
    text = col(c)
    source, target, many, expanding, marks = _folding(all_marks)
    syllables = f"\\x{{{_HANGUL[0]:X}}}-\\x{{{_HANGUL[1]:X}}}"
    # one literal that the optimiser turns into a map, in place of thousands
    table = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in many.items())), F.lit("\x01"), F.lit("\x02"))

    # translate compares the whole of its tables with those of the call before, so Latin letters have a short one
    latin = [(a, b) for a, b in zip(source, target) if a < _LATIN_END]
    latin_expanding = "".join(k for k in many if k < _LATIN_END)

    def folded(ch: Column) -> Column:
        near = F.translate(ch, "".join(a for a, _ in latin), "".join(b for _, b in latin))
        one = F.translate(ch, source, target)
        return (
            F.when((ch < _LATIN_END) & ~ch.rlike(f"[{latin_expanding}]"), near)
            .when(one != ch, one)
            .when(ch.rlike(f"[{syllables}]"), _jamo(ch))
            .when(ch.rlike(f"[{expanding}]"), F.try_element_at(table, ch))
            .when(ch.rlike(f"[{marks}]"), "")
            .otherwise(ch)
        )

    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"[^\x00-\x7F]"), F.lit(0)))
    changes = F.filter(F.transform(found, lambda ch: F.struct(ch.alias("from"), folded(ch).alias("to"))),
                       lambda x: x["from"] != x["to"])
    replaced = F.aggregate(changes, text, lambda acc, x: F.replace(acc, x["from"], x["to"]))
    return F.lower(F.when(F.octet_length(text) == F.length(text), text).otherwise(replaced))


def fold_text(c: Column | str) -> Column:
    """Compatibility-decompose, drop combining marks, lower-case."""
    return _fold(c, True)


def norm_geo(c: Column | str) -> Column:
    """Folded text with every other character turned into a space of its own."""
    return F.regexp_replace(fold_text(c), r"[^\p{L}\p{N}]", " ")


def norm_title(c: Column | str) -> Column:
    """Folded text, punctuation to spaces, spaces collapsed."""
    return F.trim(F.regexp_replace(fold_text(c), r"[^\p{L}\p{N}]+", " "))


def norm_ascii(c: Column | str) -> Column:
    """Text in which only a-z and 0-9 survive; of the marks only U+0300 to U+036F join their
    letter, all others separate words, as in the browser."""
    return F.trim(F.regexp_replace(_fold(c, False), "[^a-z0-9]+", " "))


def tokens(normalised: Column) -> Column:
    return F.filter(F.split(normalised, " +"), lambda w: w != "")


def sig_tokens(c: Column | str) -> Column:
    """Set of significant words: longer than three characters."""
    return F.array_distinct(F.filter(tokens(norm_title(c)), lambda w: F.length(w) > 3))


def set_overlap(a: Column | str, b: Column | str) -> Column:
    """How many distinct elements two arrays share."""
    return F.size(F.array_intersect(col(a), col(b)))


def long_tokens(c: Column | str) -> Column:
    """Distinct ASCII words of at least four characters."""
    return F.array_distinct(F.filter(F.split(norm_ascii(c), " "), lambda w: F.length(w) >= 4))


def word_start_pattern(stems) -> str:
    """One alternation that finds any stem at the start of a word of padded text."""
    escaped = ["".join("\\" + ch if ch in r"\.[]{}()*+-?^$|" else ch for ch in s.lstrip()) for s in stems]
    return " (?:" + "|".join(escaped) + ")"


def has_stem(c: Column | str, stems) -> Column:
    if not stems:
        return F.lit(False)
    padded = F.concat(F.lit(" "), F.coalesce(norm_geo(c), F.lit("")), F.lit(" "))
    return padded.rlike(word_start_pattern(stems))


def code_prefixes(codes: Column | str, length: int) -> Column:
    """Distinct leading parts of the codes (5 = region, 4 = CPV group)."""
    return F.array_distinct(F.transform(col(codes), lambda x: F.substring(x, 1, length)))


def parse_cz_number(c: Column | str) -> Column:
    """'1 234 567,50' to a double; NULL when unreadable or under 10,000."""
    plain = F.regexp_replace(col(c), r"[ .\u00a0]", "")
    number = F.replace(plain, F.lit(","), F.lit(".")).try_cast("double")
    return F.when(number >= fv.DOC_MIN_AMOUNT, number)


def parse_cz_datetime(c: Column | str) -> Column:
    """'dd.MM.yyyy[ HH:mm]' to an ISO string; NULL when it does not start like that."""
    text = col(c)
    day = r"^(\d{2})\.(\d{2})\.(\d{4})"
    iso = F.concat_ws(
        "-", F.regexp_extract(text, day, 3), F.regexp_extract(text, day, 2), F.regexp_extract(text, day, 1)
    )
    clock = F.regexp_extract(text, day + r"\s+(\d{2}:\d{2})", 4)
    with_clock = F.concat(iso, F.lit("T"), clock, F.lit(":00"))
    return F.when(text.rlike(day), F.when(clock != "", with_clock).otherwise(iso))


def format_change_value(field: str, c: Column | str) -> Column:
    """Display text of a tracked field; a dash for missing."""
    value = col(c)
    dash = F.lit("—")
    if field == "value":
        number = value.cast("double")
        text = F.concat(F.replace(F.format_number(F.bround(number, 0), 0), F.lit(","), F.lit(" ")), F.lit(" Kč"))
        return F.when(number.isNull() | (number == 0), dash).otherwise(text)
    text = value.cast("string")
    if field in ("deadline", "site_visit"):
        text = F.replace(F.substring(text, 1, 16), F.lit("T"), F.lit(" "))
    missing = value.isNull() | (value.cast("string") == "")
    return F.when(missing, dash).otherwise(text)


@cache
def _references() -> tuple[str, str, str, str]:
    """From the HTML 5 table: names with their semicolon, names that do without, and low codes that
    stand for other characters (each as text for a map), and a pattern for a name without semicolon."""
    joined = lambda pairs: "\x02".join(f"{k}\x01{v}" for k, v in pairs)
    bare = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
    return (
        joined((n, c) for n, c in html.entities.html5.items() if n.endswith(";")),
        joined((n, html.entities.html5[n]) for n in bare),
        joined((n, html.unescape(f"&#{n};")) for n in range(0xA0)),
        "^(?:" + "|".join(bare) + ")",
    )


def html_unescape(c: Column | str) -> Column:
    """Decode character references as HTML 5 does: all names, also without semicolon where that is
    allowed (then the longest name counts), decimal and hexadecimal codes."""
    text = col(c)
    full, short, low, bare = _references()
    table = lambda t: F.str_to_map(F.lit(t), F.lit("\x02"), F.lit("\x01"))
    pattern = r"(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

    def from_code(code: Column) -> Column:
        number = F.coalesce(code, F.lit(1 << 40))       # more digits than a number holds
        known = (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        none = number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
        return F.coalesce(
            F.try_element_at(table(low), number.cast("string")),
            F.when(~known, "\ufffd").when(none, ""),
            F.decode(F.unhex(F.lpad(F.hex(F.when(known, number).otherwise(0xFFFD)), 8, "0")), "UTF-32"),
        )

    def from_name(ref: Column) -> Column:
        name = F.regexp_extract(ref, bare, 0)
        return F.coalesce(
            F.try_element_at(table(full), ref),
            F.concat(F.try_element_at(table(short), name), F.substr(ref, F.length(name) + 1)),
            F.concat(F.lit("&"), ref),
        )

    def character(ref: Column) -> Column:
        digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*)", 1)
        number = F.when(digits == "", F.lit(0)).when(
            ref.rlike("^#[xX]"), F.when(F.length(digits) <= 8, F.conv(digits, 16, 10).try_cast("bigint"))
        ).otherwise(digits.try_cast("bigint"))
        return F.when(ref.startswith("#"), from_code(number)).otherwise(from_name(ref))

    # Each distinct reference is looked up once, then the text is put together again from its pieces.
    # What is used several times is bound as the variable of a one-row transform.
    bind = lambda value, fn: F.get(F.transform(F.array(value), fn), F.lit(0))

    def looked_up(t: Column) -> Column:
        refs = F.array_distinct(F.regexp_extract_all(t, F.lit("&" + pattern), F.lit(1)))
        return F.map_from_entries(F.transform(refs, lambda r: F.struct(r, character(r))))

    def decoded(x: Column) -> Column:
        def piece(p: Column, i: Column) -> Column:
            ref = F.regexp_extract(p, "^" + pattern, 1)
            return F.when(i == 0, p).otherwise(F.concat(
                F.coalesce(F.try_element_at(x["known"], ref), F.lit("&")), F.substr(p, F.length(ref) + 1)))

        return F.array_join(F.transform(F.split(x["text"], "&"), piece), "")

    whole = lambda t: bind(F.struct(t.alias("text"), looked_up(t).alias("known")), decoded)
    return bind(text, lambda t: F.when(t.contains("&"), whole(t)).otherwise(t))


def strip_tags(c: Column | str, filler: str = " ") -> Column:
    return F.regexp_replace(col(c), "<[^>]+>", filler)


def squeeze(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(c), r"[\s\u00a0]+", " "))


def first_group(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL instead of an empty string."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def url_join(base: Column | str, href: Column | str) -> Column:
    """Absolute form of a link found on a page."""
    base, href = col(base), col(href)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    path_dir = F.when(page == site, F.concat(site, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .otherwise(F.concat(path_dir, href))
    )


def url_host(c: Column | str) -> Column:
    return F.regexp_extract(col(c), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
