"""Column functions of the text stage: everything but Unicode composition stays in Catalyst."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: The Hebrew block, and two numbers with a separator.
HE = r"֐-׿"
PAIR = r"\d+\s*[/\\-]\s*\d+"
#: Unit spellings and what each becomes, in the order in which they are replaced.
UNITS = (("ממ", "mm"), ('מ"מ', "mm"), ("מילימטר", "mm"), ("millimeter", "mm"), ("מעלות", "°"))
#: Where a space goes, and the note that tells so, in this order.
SPACING = (
    (rf"([{HE}])(\d)", "inserted_space_hebrew_digit"),
    (rf"(\d)([{HE}])", "inserted_space_digit_hebrew"),
    (r"([a-zA-Z])(\d)", "inserted_space_english_digit"),
    (r"(\d)([a-zA-Z])", "inserted_space_digit_english"),
)
#: Date and time shapes; all matches of the first come before those of the second.
DATES = (r"(\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4})", r"(\d{2,4}[/.-]\d{1,2}[/.-]\d{1,2})")
TIMES = (r"(\d{1,2}:\d{2}(?::\d{2})?)", r"(\d{1,2}[:.]\d{2}\s*(?:AM|PM|am|pm))")
#: Final letters and their base forms.
FINALS, BASES = "ךםןףץ", "כמנפצ"
#: One alternation scans a text without gaps: space, pair, words, number, unit, mark, any other character.
SCANNER = rf"""(\s+|{PAIR}|[{HE}]+(?:[-־][{HE}]+)*|[a-zA-Z]+(?:-[a-zA-Z]+)*|\d+(?:\.\d+)?|mm|°|cm|%|[.,;:!?()\[\]{{}}״"'`]|[\s\S])"""


#: Texts of these characters only are composed as they are.
_MAY_COMPOSE = r"[^\x00-\u02FFא-ת]"
#: Pieces whose lengths are summed by themselves, so that spans cost time in proportion to a text's length.
_STRIDE = 128


@F.pandas_udf(StringType())
def _compose(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(text: Column) -> Column:
    """Unicode composition; only texts with characters that may compose travel to Python, nulls stand for the others."""
    may = text.rlike(_MAY_COMPOSE)
    return F.coalesce(_compose(F.when(may, text)), text)


def find_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def spaced_steps(df: DataFrame, text_col: str, out: str, notes: str) -> DataFrame:
    """Adds the text with spaces between letters and digits, and the notes of the steps that changed it. Texts without such a place pass by."""
    touched = F.col(text_col).rlike("|".join(p for p, _ in SPACING))
    steps = [text_col]
    for i, (pattern, _) in enumerate(SPACING):  # a column a step: each is computed once
        before = F.col(steps[-1])
        df = df.withColumn(f"{out}_{i}", F.when(touched, F.regexp_replace(before, pattern, "$1 $2")).otherwise(before))
        steps.append(f"{out}_{i}")
    said = F.array_compact(F.array(*(F.when(F.col(a) != F.col(b), F.lit(note)) for a, b, (_, note) in zip(steps, steps[1:], SPACING, strict=False))))
    return df.withColumns({out: F.col(steps[-1]), notes: F.when(touched, said).otherwise(F.array().cast("array<string>"))}).drop(*steps[1:])


def unit_steps(df: DataFrame, text_col: str, out: str, found: str) -> DataFrame:
    """Adds the text with unit spellings replaced, and the units met, in order of first sight. Texts without a unit pass by."""
    text = F.col(text_col)
    held = text.rlike("|".join(w for w, _ in UNITS))
    united, seen = text, []
    for spelling, unit in UNITS:
        seen.append(F.when(F.contains(united, F.lit(spelling)), F.lit(unit)))
        united = F.replace(united, F.lit(spelling), F.lit(unit))
    none = F.array().cast("array<string>")
    df = df.withColumns({f"{out}_held": held}).withColumns({out: F.when(F.col(f"{out}_held"), united).otherwise(text), f"{out}_seen": F.when(F.col(f"{out}_held"), F.array_compact(F.array(*seen))).otherwise(none)})
    degree = F.when(F.contains(out, F.lit("°")), F.array(F.lit("°"))).otherwise(none)
    return df.withColumn(found, F.array_distinct(F.concat(f"{out}_seen", degree))).drop(f"{out}_held", f"{out}_seen")


def pair_structs(text: Column, pairs: Column) -> Column:
    """Pairs (strings) with their parts and where each is first found in text; those that are gone are dropped.

    Without white space at any separator a pair is found as it is written; only other texts need a pattern for each pair.
    """
    parts = r"(\d+)\s*([/\\-])\s*(\d+)"
    loose = text.rlike(r"\d\s+[/\\-]|[/\\-]\s+\d")

    def one(p: Column) -> Column:
        a, sep, b = (F.regexp_extract(p, parts, i) for i in (1, 2, 3))
        return F.struct(p.alias("p"), a.alias("a"), sep.alias("sep"), b.alias("b"))

    def placed(p: Column) -> Column:
        plain = F.concat(p["a"], p["sep"], p["b"])
        pattern = F.concat(p["a"], F.lit(r"\s*[\Q"), p["sep"], F.lit(r"\E]\s*"), p["b"])
        return F.struct(F.when(loose, F.regexp_substr(text, pattern)).when(F.contains(text, plain), plain).alias("text"), p["a"].alias("a"), p["b"].alias("b"), p["sep"].alias("sep"))

    def spanned(p: Column) -> Column:
        start = F.instr(text, p["text"]) - 1
        return F.struct(p["text"].alias("text"), p["a"].alias("a"), p["b"].alias("b"), p["sep"].alias("sep"), start.alias("s"), (start + F.length(p["text"])).alias("e"))

    found = F.filter(F.transform(F.transform(pairs, one), placed), lambda p: p["text"].isNotNull())
    return F.when(F.size(pairs) > 0, F.transform(found, spanned)).otherwise(F.array().cast("array<struct<text:string,a:string,b:string,sep:string,s:int,e:int>>"))


def pieces(text: Column) -> Column:
    """Tokens of a text in order: structs (text, s, e), white space left out. Spans are running sums of lengths inside the text's own array."""
    plus = lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n)
    zero = F.array(F.lit(0))

    def run(all_: Column) -> Column:
        starts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(all_), F.lit(1)), F.lit(_STRIDE)), lambda i: F.aggregate(F.slice(all_, i, _STRIDE), zero, lambda acc, x: plus(acc, F.length(x))))
        return F.struct(all_.alias("p"), starts.alias("in"), F.aggregate(starts, zero, lambda acc, x: plus(acc, F.element_at(x, -1))).alias("before"))

    def token(x: Column, i: Column, r: Column) -> Column:
        block = F.floor(i / _STRIDE).cast("int")
        s = F.get(r["before"], block) + F.get(F.get(r["in"], block), i - block * _STRIDE)
        return F.struct(x.alias("text"), s.alias("s"), (s + F.length(x)).alias("e"))

    def tokens_of(r: Column) -> Column:
        return F.filter(F.transform(r["p"], lambda x, i: token(x, i, r)), lambda t: ~t["text"].rlike(r"^\s"))

    # each level of transform binds what the next one uses, so that a text is scanned once
    return F.get(F.transform(F.transform(F.array(find_all(text, SCANNER)), run), tokens_of), F.lit(0))


def dates(text: Column) -> Column:
    return F.concat(*(find_all(text, p) for p in DATES))


def times(text: Column) -> Column:
    return F.concat(*(find_all(text, p) for p in TIMES))


def token_kind(t: Column) -> Column:
    """word, number, pair, unit or punct of a scanned piece."""
    return (
        F.when(t.rlike(rf"^{PAIR}$"), "pair").when(t.isin("mm", "cm", "°", "%"), "unit").when(t.rlike(r"^\d"), "number")
        .when(t.rlike(r"""^[.,;:!?()\[\]{}"'`]$"""), "punct").otherwise("word")
    )


def token_script(t: Column) -> Column:
    """he, en, digit, mixed, or null for signs."""
    return (
        F.when(t.rlike(r"^\d"), "digit").when(t.rlike(rf"^[{HE}]"), "he").when(t.rlike("^[a-zA-Z]"), "en")
        .when(t.isin("°", "%") | t.rlike(r"""^[.,;:!?()\[\]{}"'`]$"""), F.lit(None)).otherwise("mixed")
    )


def normalize_hebrew(text: Column) -> Column:
    """Without direction marks and byte-order mark, final letters as base ones, single spaces, lower case."""
    plain = F.regexp_replace(text, r"[‎‏‪-‮⁦-⁩﻿]", "")
    return F.lower(F.regexp_replace(F.regexp_replace(F.translate(plain, FINALS, BASES), r"\s+", " "), r"^\s+|\s+$", ""))


def is_mostly_hebrew(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    hebrew = F.length(F.regexp_replace(text, r"[^א-ת]", ""))
    return F.coalesce((letters > 0) & (hebrew / letters >= 0.5), F.lit(False))


def strip_joiners(text: Column) -> Column:
    """Without spaces, hyphens, gershayim and geresh, as fuzzy matching compares."""
    return F.translate(F.coalesce(text, F.lit("")), " -״׳", "")


def phonetic(text: Column) -> Column:
    """ASCII letters, lower case, without vowels after the first, repeats collapsed."""
    s = F.lower(F.regexp_replace(text, "[^A-Za-z]", ""))
    code = F.concat(F.substring(s, 1, 1), F.regexp_replace(F.substring(s, 2, 1 << 30), "[aeiou]", ""))
    return F.regexp_replace(code, r"(.)\1+", "$1")


def deletions(text: Column) -> Column:
    """The text and all it becomes by dropping one character: two texts within one edit share a member."""
    drop = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.lit(1 << 30))))
    return F.array_distinct(F.concat(F.array(text), F.when(F.length(text) > 0, drop).otherwise(F.array().cast("array<string>"))))


def within_one_edit(a: Column, b: Column) -> Column:
    """Damerau distance of one at most: Levenshtein up to one, or one swap of neighbours."""
    swap = F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))),
        lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, F.lit(1 << 30))) == b,
    )
    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & (F.length(a) > 1) & swap)


def digits_sorted(text: Column) -> Column:
    return F.array_join(F.array_sort(find_all(text, r"(\d)")), "")
