"""Marked view of a line, validation of proposed edits, and their application.

Edits are rows of an array: struct(op, after_idx, first, last). A line here has normalized_text, pairs, numbers and tokens (array).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

OPS = "array<struct<op:string,after_idx:int,first:int,last:int>>"
#: What validate() enforces, for a reviewer.
RULES = (
    "An edit is insert_space after a token or merge_tokens of a range, with indexes that the line has.",
    "A merge may not hold a number or a pair, and no space goes into or after a pair.",
    "Digits stay as they are, none added, lost or changed.",
    "Tooth numbers come from the approved list.",
    "Set ambiguous where the line can be read in more than one way.",
)


def marked_view(lines: DataFrame, reasoning: str | None = None, example: str | None = None) -> DataFrame:
    """Adds `view`: sections for a reviewer, each between tags, with a blank line between them; empty ones are left out."""
    none = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    token = lambda t: F.concat(F.format_string("[%d] %s (%s, span=[%d, %d], script=%s)", t["idx"], t["text"], t["kind"], t["s"], t["e"], none(t["script"])), F.when(t["a"].isNotNull(), F.format_string(" [A=%s, B=%s, sep=%s]", t["a"], t["b"], t["sep"])).otherwise(F.lit("")))
    pair = lambda p: F.format_string("- %s: A=%s, B=%s, separator='%s', span=[%d, %d]", p["text"], p["a"], p["b"], p["sep"], p["s"], p["e"])
    tagged = lambda tag, *body: F.concat_ws("\n", F.lit(f"<{tag}>"), *body, F.lit(f"</{tag}>"))
    legend = ["word: letters, with inner hyphens", "number: digits, with decimals", "pair: two numbers and a separator", "unit: mm, cm, °, %", "punct: a mark"] + ([f"Reasoning: {reasoning}"] if reasoning else [])
    sections = [
        tagged("LEGEND", *map(F.lit, legend)),
        tagged("TEXT", F.concat(F.lit("Original: "), F.coalesce("raw_text", F.lit(""))), F.concat(F.lit("Normalized: "), "normalized_text")),
        tagged("TOKENS", F.array_join(F.transform(F.coalesce("tokens", F.array()), token), "\n")),
        F.when(F.size("pairs") > 0, tagged("PAIRS", F.array_join(F.transform("pairs", pair), "\n"))),
        F.when(F.size("numbers") > 0, tagged("NUMBERS", F.concat(F.lit("Found numbers: "), F.array_join("numbers", ", ")), F.concat(F.lit("Count: "), F.size("numbers").cast("string")))),
        tagged("SAFETY_RULES", *(F.lit(f"{i}. {r}") for i, r in enumerate(RULES, 1))),
        tagged("INSTRUCTIONS", F.lit('Return JSON with "ops", "canonical_terms", "tooth_groups", "intent_hints" and "ambiguous", and nothing else.')),
    ] + ([tagged("EXAMPLE", F.lit(example))] if example else [])
    return lines.withColumn("view", F.concat_ws("\n\n", *sections))


def validate(lines: DataFrame, ops_col: str = "ops", terms_col: str | None = None, fdi_col: str | None = None, valid_fdi: Column | None = None) -> DataFrame:
    """Adds `errors` (sorted) and `valid`. Without ops, terms and groups a line is valid at once.

    Codes: number:i, pair_merge:i, pair_insert:i, insert_missing, insert_range:i, merge_shape, merge_bounds:i-j,
    merge_order:i-j, empties, fdi:x, op:x.
    """
    toks, ops = F.col("tokens"), F.coalesce(F.col(ops_col), F.array().cast(OPS))
    n = F.coalesce(F.greatest(F.size(toks), F.lit(0)), F.lit(0))
    kinds = F.transform(toks, lambda t: t["kind"])
    fixed = lambda code, *kind: F.flatten(F.transform(F.filter(ops, lambda o: (o["op"] == "merge_tokens") & o["first"].isNotNull() & o["last"].isNotNull()), lambda o: F.transform(F.filter(F.when(o["first"] <= o["last"], F.sequence(o["first"], o["last"])).otherwise(F.array().cast("array<int>")), lambda i: (i >= 0) & (i < n) & F.get(kinds, i).isin(*kind)), lambda i: F.concat(F.lit(f"{code}:"), i.cast("string")))))
    one = lambda test, code: F.transform(F.filter(ops, test), code)
    is_insert, is_merge = lambda o: o["op"] == "insert_space", lambda o: o["op"] == "merge_tokens"
    shaped = lambda o: o["first"].isNotNull() & o["last"].isNotNull()
    out_of = lambda o: (o["first"] < 0) | (o["last"] > n - 1)
    ends = lambda code, o: F.concat(F.lit(f"{code}:"), o["first"].cast("string"), F.lit("-"), o["last"].cast("string"))
    delta = F.size(F.filter(ops, is_insert)) - F.size(F.filter(ops, is_merge))
    parts = [
        fixed("number", "number", "pair"), fixed("pair_merge", "pair"),
        one(lambda o: is_insert(o) & o["after_idx"].isNotNull() & (o["after_idx"] >= 0) & (F.get(kinds, o["after_idx"]) == "pair"), lambda o: F.concat(F.lit("pair_insert:"), o["after_idx"].cast("string"))),
        one(lambda o: is_insert(o) & o["after_idx"].isNull(), lambda o: F.lit("insert_missing")),
        one(lambda o: is_insert(o) & ((o["after_idx"] < 0) | (o["after_idx"] > n - 1)), lambda o: F.concat(F.lit("insert_range:"), o["after_idx"].cast("string"))),
        one(lambda o: is_merge(o) & ~shaped(o), lambda o: F.lit("merge_shape")),
        one(lambda o: is_merge(o) & shaped(o) & out_of(o), lambda o: ends("merge_bounds", o)),
        one(lambda o: is_merge(o) & shaped(o) & ~out_of(o) & (o["first"] > o["last"]), lambda o: ends("merge_order", o)),
        F.when(F.length("normalized_text") + delta <= 0, F.array(F.lit("empties"))).otherwise(F.array().cast("array<string>")),
        one(lambda o: ~o["op"].isin("insert_space", "merge_tokens"), lambda o: F.concat(F.lit("op:"), o["op"])),
    ]
    if fdi_col and valid_fdi is not None:
        parts.append(F.when(F.size(valid_fdi) > 0, F.transform(F.array_except(F.col(fdi_col), valid_fdi), lambda x: F.concat(F.lit("fdi:"), x))).otherwise(F.array().cast("array<string>")))
    nothing = F.size(ops) == 0
    for c in (terms_col, fdi_col):
        nothing = nothing & (F.coalesce(F.size(F.col(c)), F.lit(0)) <= 0) if c else nothing
    errors = F.when(nothing, F.array().cast("array<string>")).otherwise(F.array_sort(F.concat(*parts)))
    return lines.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)


def apply_ops(lines: DataFrame, ops_col: str = "ops") -> DataFrame:
    """Adds `edited`: the text with blank gaps inside merges removed and spaces added where asked, set-based over the gaps.

    Tokens keep their pieces, so pairs survive; text before the first token stays.
    """
    ops, toks, text = F.coalesce(F.col(ops_col), F.array().cast(OPS)), F.col("tokens"), F.col("normalized_text")
    n = F.size(toks)

    def piece(t: Column, i: Column) -> Column:
        after = F.when(i < n - 1, F.get(toks, i + 1)["s"]).otherwise(F.length(text))
        gap = F.substring(text, t["e"] + 1, after - t["e"])
        merged = F.exists(ops, lambda o: (o["op"] == "merge_tokens") & (o["first"] <= i) & (i < o["last"])) & (i < n - 1) & F.coalesce(F.trim(gap) == "", F.lit(False))
        left = F.when(merged, F.lit("")).otherwise(gap)
        add = F.exists(ops, lambda o: (o["op"] == "insert_space") & (o["after_idx"] == i)) & ~F.startswith(left, F.lit(" "))
        return F.concat(t["text"], F.when(add, F.lit(" ")).otherwise(F.lit("")), left)

    head = F.when(n > 0, F.substring(text, F.lit(1), F.get(toks, F.lit(0))["s"])).otherwise(text)
    return lines.withColumn("edited", F.concat(head, F.array_join(F.transform(toks, piece), "")))


def digit_check(lines: DataFrame, before: str, after: str) -> DataFrame:
    """Adds `digit_mismatch`: the two texts do not have the same digits, order aside."""
    return lines.withColumn("digit_mismatch", X.digits_sorted(F.col(before)) != X.digits_sorted(F.col(after)))


def survivors(lines: DataFrame, after: str) -> DataFrame:
    """Adds `missing`: numbers and pairs that the edited text no longer holds."""
    held = lambda x: F.contains(F.col(after), x)
    numbers = F.transform(F.filter("numbers", lambda x: ~held(x)), lambda x: F.concat(F.lit("number:"), x))
    pairs = F.transform(F.filter("pairs", lambda p: ~held(p["text"])), lambda p: F.concat(F.lit("pair:"), p["text"]))
    return lines.withColumn("missing", F.concat(numbers, pairs))


def clean_terms(terms: Column) -> Column:
    """Terms without digits, trimmed, the first of those equal but for case."""
    kept = F.filter(F.transform(terms, lambda t: F.trim(t)), lambda t: (t != "") & ~t.rlike(r"\d"))
    lower = F.transform(kept, lambda t: F.lower(t))
    return F.filter(kept, lambda t, i: F.array_position(lower, F.lower(t)) == i + 1)


def guard_terms(terms: Column, most: int = 3) -> Column:
    """The first `most` terms that start with a letter and have letters, spaces and hyphens only, 49 characters at most."""
    fine = F.filter(F.transform(terms, lambda t: F.trim(t)), lambda t: t.rlike(r"^[A-Za-z][A-Za-z \-]{0,48}$"))
    return F.slice(F.transform(fine, lambda t: F.regexp_replace(t, r"\s+", " ")), 1, most)


def hint_prompt(lines: DataFrame, most: int = 20) -> DataFrame:
    """Adds `hint_prompt`: the line's view and its first tokens, as an assistant is asked for hints; how many is part of the prompt's format."""
    told = F.transform(F.slice("tokens", 1, most), lambda t: F.format_string("[%d] %s (%s)", t["idx"], t["text"], t["kind"]))
    ask_for = F.lit('Say of which kind these tokens are. Return JSON with "token_hints" (idx, device_hint, tooth_group, clinical_term), "overall_intent" and "detected_procedures"; change no token.')
    return lines.withColumn("hint_prompt", F.concat_ws("\n\n", ask_for, "view", F.concat(F.lit("Tokens:\n"), F.array_join(told, "\n"))))


def attach_hints(tokens: DataFrame, hints: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Tokens with the last hint (highest seq) given for them; a hint's tooth group stays only if the dictionary has it, with its numbers."""
    last = hints.where("idx is not null").groupBy(*keys, "idx").agg(F.max_by(F.struct("hint", "tooth_group"), "seq").alias("h"))
    told = last.join(groups.withColumnRenamed("tooth_group", "_g"), F.col("h.tooth_group") == F.col("_g"), "left")
    told = told.select(*keys, "idx", F.col("h.hint").alias("hint"), F.col("_g").alias("tooth_group"), "fdi")
    return tokens.join(told, [*keys, "idx"], "left")
