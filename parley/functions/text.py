"""Scalar functions on text, as column builders. All stay in the JVM but the five at the end."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, IntegerType, StringType

from . import distance, matching

# Tokens that carry no speech; jamo in Unicode order; two-syllable surnames.
NOISE = ("", ".", "..", "...", "?", "!", "Q.", "q.", "Q", "q", "음", "어", "아", "응", "[음악]", "[Music]", "♪", "♫", "MBC", "BGM")
SURNAMES_2 = ("남궁", "황보", "선우", "독고", "제갈", "사공", "서문", "동방")
HONORIFICS = "님|씨"
# Hosts of search pages, which are no source; the heading of a note's fact-check section.
SEARCH_HOSTS = ("google.com", "www.google.com", "bing.com", "www.bing.com", "search.naver.com", "duckduckgo.com")
FACTS = "## 6. 객관 명제 팩트체크"


def is_noise(text: Column) -> Column:
    """Blank, or a token that carries no speech."""
    return F.trim(F.coalesce(text, F.lit(""))).isin(*NOISE)


def meaningful_chars(text: Column) -> Column:
    """Letters, digits and Hangul outside brackets and speaker tags."""
    bare = F.regexp_replace(text, r"\[[^\]]+\]", " ")
    bare = F.regexp_replace(bare, r"(?i)\bspeaker[_ -]?[0-9]+\b|speaker [a-z]|화자 [a-z]", " ")
    return F.regexp_count(bare, F.lit("[0-9A-Za-z가-힣]"))


def contains_korean(text: Column) -> Column:
    """P15."""
    return text.rlike("[가-힣]")


def jamo(text: Column) -> Column:
    """Hangul syllables to their letters, other characters unchanged. Plain arithmetic."""

    def one(ch: Column) -> Column:
        code = F.ascii(ch) - 0xAC00
        # compatibility jamo by position: a lookup in the three alphabets
        lead = F.substring(F.lit("ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"), F.floor(code / 588).cast("int") + 1, F.lit(1))
        vowel = F.substring(F.lit("ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"), F.floor((code % 588) / 28).cast("int") + 1, F.lit(1))
        tail = F.trim(F.substring(F.lit(" ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"), (code % 28).cast("int") + 1, F.lit(1)))
        return F.when(code.between(0, 11171), F.concat(lead, vowel, tail)).otherwise(ch)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, in code points; 0 if either is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(1.0 - F.levenshtein(a, b) / longer)


def jamo_similarity(a: Column, b: Column) -> Column:
    """F3."""
    return similarity(jamo(a), jamo(b))


def given_name(name: Column) -> Column:
    """a full name without its surname of one syllable, or of two."""
    n = F.length(name)
    return F.when((n >= 4) & F.substring(name, 1, 2).isin(*SURNAMES_2), F.substring(name, F.lit(3), n)).when(n >= 3, F.substring(name, F.lit(2), n)).otherwise(name)


def strip_honorific(name: Column) -> Column:
    """the name before a closing honorific."""
    bare = F.regexp_extract(F.trim(name), rf"^(.+?)(?:{HONORIFICS})$", 1)
    return F.when(bare != "", F.trim(bare)).otherwise(F.trim(name))


def honorific(name: Column) -> Column:
    return F.regexp_extract(F.trim(name), rf"^.+?({HONORIFICS})$", 1)


def variants(text: Column, dialect: str = "build") -> Column:
    """the variants in a ledger entry, without backticks around them and a closing honorific, in one of three dialects. ``scan``, of ledger lines:
    split at / , and middle dots. ``build``, of notes that a ledger is made from: the same without notes on the speaker, of at most 40 characters, as longer
    ones are sentences. ``usage``, of ledger lines whose names are looked for in notes: split at commas alone, Hangul words of two to eight syllables."""
    said = F.regexp_replace(text, r"\s*\([^)]*화자[^)]*\)\s*", " ") if dialect == "build" else text
    bare = lambda p: stripped(F.regexp_replace(stripped(F.regexp_replace(stripped(p), "^`+|`+$", "")), f"(?:{HONORIFICS})$", ""))
    parts = F.transform(F.split(said, "," if dialect == "usage" else "[/,·]"), bare)
    kept = {"scan": lambda p: p != "", "build": lambda p: (p != "") & (F.length(p) <= 40), "usage": lambda p: p.rlike("^[가-힣]{2,8}$")}
    return F.filter(parts, kept[dialect])


def target_base(target: Column) -> Column:
    """what stands before a parenthesis."""
    return F.trim(F.regexp_replace(target, r"(?s)\(.*$", ""))


def stripped(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def capped(text: Column, n: int) -> Column:
    """white space collapsed; after at most n characters cut ones end in an ellipsis."""
    c = collapsed(text)
    return F.when(F.length(c) > n, F.concat(F.rtrim(F.substring(c, 1, n)), F.lit("…"))).otherwise(c)


def cer_units(text: Column) -> Column:
    """the text without white space."""
    return F.regexp_replace(text, r"\s+", "")


def words(text: Column) -> Column:
    """white-space tokens; none for blank text."""
    return F.filter(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), lambda w: w != "")


def has_phrase(tokens: Column, phrase: Column) -> Column:
    """Whether ``phrase`` stands in ``tokens`` as neighbouring whole tokens."""
    last = F.size(tokens) - F.size(phrase) + 1
    starts = F.when((last >= 1) & (F.size(phrase) > 0), F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.exists(starts, lambda i: F.slice(tokens, i, F.size(phrase)) == phrase)


def protected(text: Column) -> Column:
    """The numbers, negations and commitments that a correction must not change."""
    return F.array(
        F.array_join(F.regexp_extract_all(text, F.lit(r"[0-9]+(?:[.,:][0-9]+)*"), F.lit(0)), "\x01"),
        F.array_join(F.regexp_extract_all(text, F.lit("안|못|없|아니|않|말"), F.lit(0)), "\x01"),
        F.array_join(F.regexp_extract_all(text, F.lit("(?i)해야|하기로|예정|담당|기한|까지|완료|ASAP"), F.lit(0)), "\x01"),
    )


def slug(text: Column, n: int = 60) -> Column:
    """a file-name-safe form of a title."""
    s = F.regexp_replace(F.trim(text), r"^[-*•\s]+", "")
    s = F.regexp_replace(s, r"[\\/:*?\"<>|#%&{}$!'@+`=]", "")
    s = F.rtrim(F.substring(F.regexp_replace(s, r"\s+", "-"), 1, n))
    return F.when(s == "", F.lit("untitled")).otherwise(s)


def anchor(heading: Column) -> Column:
    """the anchor of a Markdown heading: letters, digits and Hangul in lower case, joined by hyphens."""
    return F.concat(F.lit("#"), F.regexp_replace(F.lower(F.trim(F.regexp_replace(heading, "[^0-9A-Za-z가-힣 -]+", ""))), "[ -]+", "-"))


def plain_markdown(text: Column) -> Column:
    """links, bold, emphasis and code reduced to their text."""
    t = F.regexp_replace(text, r"\[([^\]]+)\]\([^)]*\)", "$1")
    t = F.regexp_replace(t, r"\*\*([^*]+)\*\*", "$1")
    t = F.regexp_replace(t, r"`([^`]+)`", "$1")
    return F.trim(F.regexp_replace(t, r"[*_]([^*_]+)[*_]", "$1"))


def without_controls(text: Column) -> Column:
    """F18."""
    return F.regexp_replace(text, r"\p{C}", "")


def unescaped(text: Column) -> Column:
    """Markdown escapes undone."""
    return F.regexp_replace(text, r"\\([\\`*_{}\[\]()#+.!~>|-])", "$1")


def without_particle(text: Column) -> Column:
    """a source without its closing particle."""
    return F.regexp_replace(collapsed(text), "(?:까지|부터|에서|으로|로|에게|한테|에|은|는|이|가|을|를)$", "")


def without_prefix(line: Column) -> Column:
    """F8, a line: without a leading time in brackets, or one before a speaker, and without the speaker."""
    time = r"(?:[0-9]{1,2}:)?[0-9]{1,2}:[0-9]{2}(?:[.,][0-9]+)?"
    speaker = r"^\s*(?:(?:화자|(?i:speaker))\s*(?:[A-Za-z0-9가-힣_-]{1,32}|\?)\s*[:：]|(?:[A-Z]|S[1-9][0-9]*|\?)\s*[:：])\s*"
    bare = F.regexp_replace(line, rf"^\s*\[\s*{time}(?:\s*-\s*{time})?\s*\]\s*", "")
    open_time = F.regexp_replace(line, rf"^\s*{time}(?=\s+)", "")
    timed = F.when(bare != line, bare).when(open_time.rlike(speaker), open_time).otherwise(line)
    return collapsed(F.regexp_replace(timed, speaker, ""))


def normalized(text: Column) -> Column:
    """F8: NFC, then every line without its prefixes, blank lines dropped, joined by spaces."""
    lines = F.transform(F.split(nfc(text), r"\r\n|\r|\n"), without_prefix)
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def chunked(text: Column, n: int = 2000) -> Column:
    """Pieces of n characters; none of an empty text."""
    count = F.ceil(F.length(text) / n).cast("int")
    starts = F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i * n + 1, F.lit(n)))


def direct_https(url: Column) -> Column:
    """An https address with a host that isn't one of the search pages."""
    host = F.lower(F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")))
    return (F.lower(F.coalesce(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit(""))) == "https") & (host != "") & ~host.isin(*SEARCH_HOSTS)


def one_line(text: Column) -> Column:
    """on one line, with double quotes as closing ones."""
    return F.replace(collapsed(text), F.lit('"'), F.lit("”"))


def link_text(text: Column) -> Column:
    """on one line, with round brackets for square ones."""
    return F.translate(one_line(text), "[]", "()")


def without_facts(text: Column) -> Column:
    """a note without its fact-check section, ending in one line break; doing it again changes nothing."""
    cut = F.regexp_replace(F.regexp_replace(text, r"\s+\z", ""), rf"(?s)\n\Q{FACTS}\E\n.*\z", "")
    return F.concat(F.regexp_replace(cut, r"\s+\z", ""), F.lit("\n"))


def note_hash(text: Column) -> Column:
    """the sha256 of a note without its fact-check section."""
    return F.sha2(without_facts(text), 256)


def with_facts(text: Column, section: Column) -> Column:
    """a note with ``section`` as its one fact-check section, at its end."""
    return F.concat(without_facts(text), F.lit("\n"), section)


def like_escaped(term: Column) -> Column:
    """a term in which LIKE's wildcards stand for themselves."""
    return F.regexp_replace(term, r"([\\%_])", r"\\$1")


def joined_words(words: Column) -> Column:
    """words as a recogniser gives them, one after another; with spaces between them if none brings one along."""
    compact = stripped(F.array_join(words, ""))
    spaced = F.array_join(F.filter(F.transform(words, stripped), lambda w: w != ""), " ")
    return F.when((F.size(words) > 1) & ~compact.contains(" ") & (spaced != ""), spaced).otherwise(compact)


def shortened(text: Column, n: int) -> Column:
    """at most n characters, cut ones ending in an ellipsis."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n - 1), F.lit("…"))).otherwise(text)


def wrapped(text: Column, width: int, most: int = 2) -> Column:
    """at most ``most`` lines of words within ``width`` where they fit; the last one ends in an ellipsis if words are left."""
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit("").alias("now"), F.lit(False).alias("full"))

    def step(a: Column, word: Column) -> Column:
        longer = F.when(a["now"] == "", word).otherwise(F.concat_ws(" ", a["now"], word))
        fits = a["full"] | (F.length(longer) <= width)
        lines = F.when(fits | (a["now"] == ""), a["lines"]).otherwise(F.concat(a["lines"], F.array(a["now"])))
        now = F.when(a["full"], a["now"]).when(fits, longer).otherwise(word)
        return F.struct(lines.alias("lines"), now.alias("now"), (a["full"] | (~fits & (F.size(lines) == most - 1))).alias("full"))

    def end(a: Column) -> Column:
        lines = F.when((a["now"] != "") & (F.size(a["lines"]) < most), F.concat(a["lines"], F.array(a["now"]))).otherwise(a["lines"])
        return F.slice(lines, 1, most)

    lines = F.aggregate(words(text), start, step, end)
    last = F.concat(shortened(F.element_at(lines, -1), max(width - 1, 2)), F.lit("…"))
    cut = F.concat(F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(0))), F.array(last))
    return F.when(F.size(lines) == 0, F.array(F.lit(""))).when(F.length(F.array_join(lines, " ")) < F.length(text), cut).otherwise(lines)


def string_list(values: Column, most: int) -> Column:
    """the strings of an array that aren't blank, each on one line and capped."""
    return F.transform(F.filter(values, lambda v: F.coalesce(F.trim(v), F.lit("")) != ""), lambda v: capped(v, most))


def safe_int(value: Column) -> Column:
    """an integer, or 0."""
    return F.coalesce(value.try_cast("long"), F.lit(0)).cast("long")


# No built-in function gives these; they run on Arrow batches.


@pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """Unicode composition."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@pandas_udf(DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """twice the matched characters over all, by longest matching blocks; a null is an empty text."""
    return pd.Series([matching.ratio(x or "", y or "") for x, y in zip(a, b)])


def edits(a: Sequence, b: Sequence) -> int:
    """F2 of two sequences of any length: bit vectors of a column's vertical steps (Myers, Hyyrö), as
    integers of as many bits as the shorter one has items. Equal ends are left out first."""
    if len(a) > len(b):
        a, b = b, a
    low, high = 0, len(a)
    while low < high and a[low] == b[low]:
        low += 1
    while high > low and a[high - 1] == b[high - len(a) - 1]:
        high -= 1
    a, b = a[low:high], b[low : len(b) - (len(a) - high)]
    at: dict = {}
    for i, x in enumerate(a):
        at.setdefault(x, []).append(i)
    held = {}
    for x, places in at.items():
        bits = bytearray((len(a) + 7) // 8)
        for i in places:
            bits[i >> 3] |= 1 << (i & 7)
        held[x] = int.from_bytes(bits, "little")
    more, side = len(b) - len(a), 32
    while more + 2 * side + 1 < len(a) // 2:
        found = _banded(held, b, more, side)
        if found <= more + 2 * side + 1:  # a path of so few edits leaves no diagonal of the band
            return found
        side = min(4 * side, (found - more) // 2 + 1)
    mask = (1 << len(a)) - 1
    up, down = mask, 0
    for x in b:
        eq = held.get(x, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = ((down | ~(xh | up)) << 1) | 1
        down, up = ph & xv, (((up & xh) << 1) | ~(xv | ph)) & mask
    return len(b) + up.bit_count() - down.bit_count()


def _banded(held: dict, b: Sequence, more: int, side: int) -> int:
    """The fewest edits of a path within ``side`` diagonals of the two that the ends lie on: a window of the
    bit vectors moves down with the columns. Columns come in blocks, whose part of ``held`` is cut out once."""
    width, above = more + 2 * side + 1, more + side
    mask, end = (1 << width) - 1, 1 << side
    up, down, edits_ = mask ^ ((1 << above) - 1), 0, 0
    for first in range(0, len(b), width):
        part, cut = {}, (1 << 2 * width) - 1
        for j, x in enumerate(b[first : first + width]):
            if (bits := part.get(x)) is None:
                bits = held.get(x, 0)
                part[x] = bits = ((bits >> (first - above)) if first >= above else (bits << (above - first))) & cut
            eq = (bits >> j) & mask
            zero = (((eq & up) + up) ^ up) | eq | down
            plus = down | ~(zero | up)
            if not zero & end:
                edits_ += 1
            minus, zero = zero & up, (zero & mask) >> 1
            down, up = zero & plus, (minus | ~(zero | plus)) & mask
    return edits_


#: Items of both sides that are compared at once.
TOGETHER = 1 << 19


def _distances(a: pd.Series, b: pd.Series, of: Callable) -> pd.Series:
    """Of a batch at once where few edits suffice, and then of the others together; null where either side is."""
    known = (a.notna() & b.notna()).to_numpy()
    out = pd.Series([None] * len(a), dtype="Int32")
    at = np.flatnonzero(known)
    la, lb = (np.array([len(s.iloc[i]) for i in at], np.int64) for s in (a, b))
    late = np.abs(la - lb) > distance.limits(np.maximum(la, lb))  # more edits than that by their lengths alone
    far, at = at[late].tolist(), at[~late]
    upto, first = np.cumsum((la + lb)[~late]), 0
    while first < len(at):  # so many pairs together that their numbers stay small in memory, however long the batch's texts are
        stop = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + TOGETHER, "right")))
        some = at[first:stop]
        xs, ys = a.iloc[some].tolist(), b.iloc[some].tolist()
        out.iloc[some] = of(xs, ys, lambda i: far.append(int(some[i])) or 0)
        first = stop
    if far:
        pairs = [(a.iloc[i], b.iloc[i]) for i in far]
        out.iloc[far] = distance.in_vectors(pairs, lambda i: edits(*pairs[i]))
    return out


#: Characters of both sides whose pairs are put together by their lengths, over batches.
GATHERED = 1 << 23


@pandas_udf(IntegerType())
def edit_distance(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """F2 of whole texts, in code points; null if either is."""

    def done(held: list) -> Iterator[pd.Series]:
        all_ = _distances(*(pd.concat(side, ignore_index=True) for side in zip(*held)), distance.of_texts)
        first = 0
        for a, _ in held:
            yield all_.iloc[first : first + len(a)]
            first += len(a)

    held, size = [], 0
    for a, b in batches:
        held.append((a, b))
        size += int(a.str.len().sum() + b.str.len().sum())
        if size >= GATHERED:
            yield from done(held)
            held, size = [], 0
    if held:
        yield from done(held)


@pandas_udf(IntegerType())
def token_edit_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """F2 of whole arrays of tokens; null if either is."""
    return _distances(a.map(lambda x: None if x is None else list(x)), b.map(lambda x: None if x is None else list(x)), distance.of_tokens)
