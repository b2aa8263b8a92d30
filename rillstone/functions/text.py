"""Text normalisation and repair as Column functions; all run inside the JVM but for `ratio`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits of one other script, and glyphs that readers confuse with digits or letters.
SCRIPT_DIGITS, PLAIN_DIGITS = "०१२३४५६७८९", "0123456789"
GLYPHS, GLYPH_DIGITS = "OoDQIl|/SBZ", "00001117582"
ZONE_DIGITS, ZONE_LETTERS = "0125867", "OIZSBGY"
# What is stripped at the ends of names and of values, and glyphs that stand for I or l.
NAME_ENDS, VALUE_ENDS, BARS = " -–:।", " :;.।|_=+*?¢~`'\"-", r"[|!\[\]]"


def collapse(c: Column) -> Column:
    """White space runs become one space; none at the ends."""
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "))


def normalize(c: Column) -> Column:
    return F.upper(collapse(c))


def first_last(c: Column) -> Column:
    """(first, last) token of the normalised text; null with fewer than two tokens."""
    t = F.split(normalize(c), " ")
    return F.when(F.size(t) >= 2, F.struct(F.element_at(t, 1).alias("first"), F.element_at(t, -1).alias("last")))


def strip_charset(c: Column, chars: str = NAME_ENDS) -> Column:
    """Foreign digits become plain ones, white space collapses, `chars` go at both ends."""
    return F.btrim(collapse(F.translate(c, SCRIPT_DIGITS, PLAIN_DIGITS)), F.lit(chars))


def clean_value(c: Column, noise: str = VALUE_ENDS) -> Column:
    """Noise glyphs go at both ends; if nothing is left, a dash that was there stays."""
    stripped = F.btrim(collapse(F.coalesce(c, F.lit(""))), F.lit(noise))
    return F.when((stripped == "") & F.contains(c, F.lit("-")), F.lit("-")).otherwise(stripped)


def digits_int(c: Column) -> Column:
    """The digits of a text as one number; null without any (or beyond a long)."""
    d = F.regexp_replace(F.translate(c, SCRIPT_DIGITS, PLAIN_DIGITS), "[^0-9]", "")
    return F.nullif(d, F.lit("")).try_cast("bigint")


def digits_repair(c: Column) -> Column:
    """digits_int, with confusable glyphs read as digits unless the text is all digits."""
    t = F.translate(c, SCRIPT_DIGITS, PLAIN_DIGITS)
    return digits_int(F.when(F.btrim(t).rlike("^[0-9]+$"), t).otherwise(F.translate(t, GLYPHS, GLYPH_DIGITS)))


def extract_decimal(c: Column) -> Column:
    """The first signed decimal, as text; empty without any."""
    return F.regexp_extract(c, r"-?\d+\.\d+", 0)


def alnum_code(c: Column, extra: str = "") -> Column:
    return F.regexp_replace(F.upper(c), f"[^A-Z0-9{extra}]", "")


def positional_repair(c: Column, head: int = 3) -> Column:
    """Letters for digits in the first `head` places, digits for letters behind them; short codes stay."""
    fixed = F.concat(F.translate(F.substring(c, 1, head), ZONE_DIGITS, ZONE_LETTERS), F.translate(F.substr(c, F.lit(head + 1)), ZONE_LETTERS, ZONE_DIGITS))
    return F.when(F.char_length(c) <= head, c).otherwise(fixed)


def word_transform(c: Column, bars: str = BARS) -> Column:
    """Bar-like glyphs in a word become I if its letters are all upper case, else l."""

    def word(w: Column) -> Column:
        letters = F.regexp_replace(w, r"[^\p{L}]", "")
        upper = (letters != "") & (letters == F.upper(letters))
        return F.when(w.rlike(bars), F.regexp_replace(w, F.lit(bars), F.when(upper, "I").otherwise("l"))).otherwise(w)

    return F.array_join(F.transform(F.split(collapse(c), " "), word), " ")


def vocab_snap(c: Column, vocabulary: Sequence[str], most: int = 2) -> Column:
    """The word of a closed vocabulary that is nearest, if it is unique and `most` edits away at most; else the text."""
    scored = F.array_sort(F.transform(F.array(*[F.lit(v) for v in vocabulary]), lambda v: F.struct(F.levenshtein(F.lower(c), F.lower(v)).alias("d"), v.alias("v"))))
    first, second = F.get(scored, F.lit(0)), F.get(scored, F.lit(1))
    ok = (first["d"] <= most) & (second.isNull() | (second["d"] > first["d"]))
    return F.when(ok, first["v"]).otherwise(c)


def last_vocab_token(lines: Column, vocabulary: Sequence[str], shortest: int = 3) -> Column:
    """The first token, lines taken from the last one up, that snaps to the vocabulary."""
    words = F.flatten(F.transform(F.reverse(lines), lambda x: F.split(x, r"[\s:;.,|]+")))
    known = F.array(*[F.lit(v) for v in vocabulary])
    return F.get(F.filter(F.transform(F.filter(words, lambda w: F.char_length(w) >= shortest), lambda w: vocab_snap(w, vocabulary)), lambda w: F.array_contains(known, w)), F.lit(0))


def regex_strip(c: Column, patterns: Sequence[str]) -> Column:
    """Each pattern's matches become a space; commas and white space are tidied."""
    for p in patterns:
        c = F.regexp_replace(c, p, " ")
    return F.btrim(collapse(F.regexp_replace(c, r"\s*,(\s*,)+", ", ")), F.lit(", "))


def strip_words(c: Column, words: Sequence[str]) -> Column:
    """Whole white-space separated words of the list go."""
    return F.array_join(F.filter(F.split(collapse(c), " "), lambda w: ~w.isin(*words)), " ")


def fixpoint_strip(c: Column, pattern: str, generic: Sequence[str] = (), letter: str = r"[\p{L}]") -> Column:
    """A trailing pattern goes again and again until nothing changes, but never down to a generic word or to no letter.

    Every removal shortens the text, so its length bounds them; once nothing changes the pattern isn't tried again.
    """

    def step(a: Column, _: Column) -> Column:
        cut = F.btrim(F.regexp_replace(a["text"], pattern, ""))
        ok = (cut != a["text"]) & cut.rlike(letter)
        if generic:
            ok = ok & ~F.lower(cut).isin(*generic)
        return F.when(a["done"], a).otherwise(F.when(ok, F.struct(cut.alias("text"), F.lit(False).alias("done"))).otherwise(F.struct(a["text"].alias("text"), F.lit(True).alias("done"))))

    tidy = collapse(c)
    return F.when(c.isNotNull(), F.aggregate(F.sequence(F.lit(0), F.char_length(tidy)), F.struct(tidy.alias("text"), F.lit(False).alias("done")), step, lambda a: a["text"]))


def prefix_len(a: Column, b: Column) -> Column:
    """Characters that two texts share at their beginning."""
    n = F.least(F.char_length(a), F.char_length(b))
    return F.size(F.filter(F.sequence(F.lit(0), n), lambda i: F.left(a, i) == F.left(b, i))) - 1


def edit_within(a: Column, b: Column, k: int) -> Column:
    return F.levenshtein(a, b, k) >= 0


def split_tail(c: Column, separator: str = ",") -> tuple[Column, Column]:
    """What is before the first and behind the last separator."""
    return F.btrim(F.substring_index(c, separator, 1)), F.btrim(F.substring_index(c, separator, -1))


def keyword_cut(c: Column, keywords: Sequence[str], before: bool = False) -> Column:
    """What follows the right-most end of any keyword, or (before) all up to that end; empty without one."""
    end = lambda k: F.when(F.contains(c, k), F.char_length(c) - F.instr(F.reverse(c), F.reverse(k)) + 1)
    ends = F.array_compact(F.transform(F.array(*[F.lit(k) for k in keywords]), end))
    kept = F.left(c, F.array_max(ends)) if before else F.substr(c, F.array_max(ends) + 1)
    return F.when(F.size(ends) > 0, F.btrim(kept)).otherwise(F.lit(""))


def clean_area(c: Column, words: Sequence[str], rooms: Sequence[str] = (), tail: str | None = None) -> Column:
    """A place left over from an address: rooms (patterns), dots and listed words go, as do number tails and unbalanced
    brackets; no letter, nothing."""
    t = strip_charset(F.regexp_replace(strip_words(F.regexp_replace(regex_strip(c, rooms) if rooms else c, "[.।,]", " "), words), r"\(\s*\)", " "), "-, ")
    t = fixpoint_strip(t, tail) if tail else t
    count = lambda x: F.char_length(t) - F.char_length(F.replace(t, F.lit(x), F.lit("")))
    t = F.when(count("(") != count(")"), collapse(F.translate(t, "()", "  "))).otherwise(t)
    return F.when(t.rlike(r"[\p{L}]"), t).otherwise(F.lit(""))


def stem_number(path: Column) -> Column:
    """The digits of a file's name without its folders and ending, as a number."""
    return digits_int(F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1))


def range_list(c: Column) -> Column:
    """'1-3,7' as [1, 2, 3, 7]; a range from a larger to a smaller number is empty, and chunks that are no numbers give none."""
    a, b = (lambda x: F.split_part(x, F.lit("-"), F.lit(1)).try_cast("bigint")), (lambda x: F.split_part(x, F.lit("-"), F.lit(2)).try_cast("bigint"))
    none = F.array().cast("array<bigint>")
    one = lambda x: F.when(~F.contains(x, F.lit("-")), F.array_compact(F.array(x.try_cast("bigint")))).when(a(x) <= b(x), F.sequence(a(x), b(x))).otherwise(none)
    return F.flatten(F.transform(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s", ""), ","), one))


def integer_list(c: Column) -> Column:
    """All runs of digits; a dash makes no range."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("bigint"))


def qualified(name: Column, qualifier: Column, summary: str = "etc", tail: str | None = None, like: Column | None = None) -> Column:
    """name (qualifier), unless the qualifier is empty, a list, a summary, the name itself or, as `like` says, similar to it.

    With `tail`, a pattern, the qualifier's number tails go first.
    """
    q = strip_charset(qualifier)
    q = fixpoint_strip(q, tail) if tail else q
    skip = q.isNull() | (q == "") | F.contains(q, F.lit("/")) | F.contains(q, F.lit(summary)) | (q == name)
    skip = skip if like is None else skip | F.coalesce(like, F.lit(False))
    return F.when(skip, name).otherwise(F.concat(name, F.lit(" ("), q, F.lit(")")))
