"""Line-first quality rules, in DataFrame operations only.

Every line is judged by itself: too many symbols (punctuation), too many shouting marks, navigation
separators, boilerplate phrases. Lines that fail are removed, and a document that loses more than
``MAX_LOSS`` per cent of its word characters, or fails the base rules of whole texts, is rejected.
The base rules count words, symbols, repeated lines and words in repeated windows of three words.

Windows are compared inside the row: 64-bit hashes and positions share one sorted array of longs,
so nothing is exploded or shuffled. The position takes as many low bits as the text needs; equal
high bits are verified word by word, and where they deceive (they hardly ever do), the document's
repeated candidates are compared with one another.

Defined cases: a null, empty or blank text has no words and no lines and fails the base; repeated
rows are judged alike; an empty table gives no rows; other columns pass through, and those named
like the outputs are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.llm.frames import without

MIN_WORDS = 50
MAX_REPEATED = 50           # per cent of words in repeated windows
MAX_LOSS = 50               # per cent of word characters in removed lines
LINE_SYMBOLS = 0.3          # symbols a word
LINE_SHOUTS = 0.3           # groups of ! or ? a word
LINE_BARS = 0.2             # separators a word, and at least
LEAST_BARS = 3
# fixed values: phrases of page furniture
BOILERPLATE = (
    "accept all cookies", "this site uses cookies", "we use cookies", "cookie policy", "privacy policy", "terms of use",
    "terms of service", "terms and conditions", "all rights reserved", "enable javascript", "javascript is disabled",
    "click here to", "sign up for our", "subscribe to our newsletter", "skip to content", "back to top", "share on facebook",
    "share this article", "related articles", "read more articles", "log in to comment", "lorem ipsum",
)

_WORD = r"[^\\x20\\x09-\\x0D]+"
_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_removed_lines",
            "removed_chars", "base_failed", "kept", "clean_text"]


def _failing_line() -> str:
    """SQL condition on a line ``l``."""
    words = f"size(regexp_extract_all(l, '{_WORD}', 0))"
    phrases = " OR ".join(f"contains(lower(l), '{p}')" for p in BOILERPLATE)
    return (f"regexp_count(l, '[#*$%&|<>~^]') > {LINE_SYMBOLS} * {words} OR regexp_count(l, '[!?]{{2,}}') > {LINE_SHOUTS} * {words} "
            f"OR (regexp_count(l, '[|»›•]') >= {LEAST_BARS} AND regexp_count(l, '[|»›•]') > {LINE_BARS} * {words}) OR {phrases}")


def judge_lines(docs: DataFrame, *, text: str = "text", keep_clean: bool = True) -> DataFrame:
    """The documents with the base counts, base_failed, kept, the counts of removed lines and, if
    ``keep_clean``, clean_text: the lines that pass."""
    own = without(docs, [*_COLUMNS, "_t", "_w", "_lines", "_good", "_mask", "_sorted", "_dups", "_at", "_false"])
    rest = [f"`{c}`" for c in own.columns]
    step = own.withColumn("_t", F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))
    step = step.selectExpr(
        *rest, "regexp_count(_t, '[#*$%&|<>]') AS n_symbols", f"regexp_extract_all(_t, '{_WORD}', 0) AS _w",
        f"filter(split(_t, '\\n', -1), l -> l rlike '{_WORD}') AS _lines")
    step = step.selectExpr(
        *rest, "n_symbols", "_w", "_lines", "bigint(size(_w)) AS n_words", "length(array_join(_w, '')) AS word_chars",
        "size(_lines) - size(array_distinct(_lines)) AS n_dup_lines", f"filter(_lines, l -> NOT ({_failing_line()})) AS _good",
        "shiftleft(1L, length(bin(size(_w)))) - 1 AS _mask")
    window = "xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2))"
    step = step.selectExpr(
        *rest, "n_symbols", "_w", "_lines", "n_words", "word_chars", "n_dup_lines", "_good", "_mask",
        "sort_array(IF(size(_w) < 3, CAST(array() AS array<bigint>), transform(sequence(0, size(_w) - 3), "
        f"i -> coalesce(({window} & ~_mask) | i, 0L)))) AS _sorted")
    step = step.selectExpr(
        *rest, "n_symbols", "_w", "_lines", "n_words", "word_chars", "n_dup_lines", "_good", "_mask",
        "filter(_sorted, (x, i) -> coalesce((x ^ get(_sorted, i - 1)) <= _mask AND (x ^ get(_sorted, i - 1)) >= 0, false) "
        "OR coalesce((x ^ get(_sorted, i + 1)) <= _mask AND (x ^ get(_sorted, i + 1)) >= 0, false)) AS _dups")
    same = ("get(_w, int({a} & _mask)) = get(_w, int({b} & _mask)) AND get(_w, int({a} & _mask) + 1) = get(_w, int({b} & _mask) + 1) "
            "AND get(_w, int({a} & _mask) + 2) = get(_w, int({b} & _mask) + 2)")
    step = step.selectExpr(
        *rest, "n_symbols", "_w", "_lines", "n_words", "word_chars", "n_dup_lines", "_good", "_mask", "_dups",
        # neighbours with equal high bits whose words differ
        "coalesce(size(filter(_dups, (x, i) -> coalesce((x ^ get(_dups, i - 1)) <= _mask AND (x ^ get(_dups, i - 1)) >= 0, false) "
        f"AND NOT ({same.format(a='x', b='get(_dups, i - 1)')}))), 0) AS _false")
    step = step.selectExpr(
        *rest, "n_symbols", "_lines", "n_words", "word_chars", "n_dup_lines", "_good",
        "sort_array(transform(IF(_false = 0, _dups, filter(_dups, x -> exists(_dups, y -> x != y AND "
        f"{same.format(a='x', b='y')}))), x -> coalesce(x & _mask, 0L))) AS _at")
    step = step.selectExpr(
        *rest, "n_words", "bigint(word_chars) AS word_chars", "bigint(n_symbols) AS n_symbols", "bigint(n_dup_lines) AS n_dup_lines",
        # every window covers three words, less where the next one begins sooner
        "IF(size(_at) = 0, 0L, 3 + aggregate(sequence(0, size(_at) - 1), 0L, (a, i) -> a + IF(i = 0, 0L, "
        "least(3L, get(_at, i) - get(_at, i - 1))))) AS n_repeat_words",
        "bigint(size(_lines)) AS n_lines", "bigint(size(_lines) - size(_good)) AS n_removed_lines",
        f"bigint(word_chars - length(array_join(transform(_good, l -> regexp_replace(l, '[\\\\x20\\\\x09-\\\\x0D]+', '')), ''))) AS removed_chars",
        *(["array_join(_good, '\n') AS clean_text"] if keep_clean else []))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return step.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("removed_chars") <= MAX_LOSS * F.col("word_chars")))
