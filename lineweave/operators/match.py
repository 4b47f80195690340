"""Matching of tokens to surfaces: exact, fuzzy, phonetic, then windows of words; spans, hints, priors, coverage.

Token rows have keys, idx, text, kind, s, e; surfaces have seq, surface, iri, label, match_type, score_lex, iri_source. All joins
are equi-joins; the fuzzy one meets on words with one character dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.durable import stored

#: Bands of fuzzy scores, score of phonetic matches, words of a window at most.
FUZZY_LOW, FUZZY_HIGH, SHORT_LOW, SHORT_HIGH, PHONETIC, NGRAM_MAX = 0.70, 0.85, 0.65, 0.88, 0.83, 5
#: Words that give a hint, and surfaces that give one as a whole.
HINTS = (("device_hint", ("abutment", "implant", "שתל")), ("material_hint", ("zirconia", "titanium")), ("finding_hint", ("caries",)))
WHOLE_HINTS = (("device_hint", ("מולטיוניט", "mu", "mua")), ("implant_hint", ("שתל", "שלת")))
#: The spelling that counts as a near miss of the other.
MISSPELT, SPELT, MISSPELT_SCORE = "שלת", "שתל", 0.82
PLACEHOLDERS = ("IMPLANT:", "DEVICE:", "HE2EN:")
_META = ["seq", "iri", "label", "match_type", "score_lex", "iri_source"]


def _best(df: DataFrame, keys: list[str], *order) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def words(tokens: DataFrame) -> DataFrame:
    return tokens.where("kind = 'word'").withColumn("norm", X.normalize_hebrew(F.lower("text")))


def exact(words_: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Words that equal a surface; the misspelt variant is lowered to a near miss."""
    hit = words_.join(surfaces, F.col("norm") == F.col("surface")).drop("surface")
    miss = F.col("norm") == MISSPELT
    return hit.withColumns({"match_type": F.when(miss, "fuzzy").otherwise(F.col("match_type")), "score_lex": F.when(miss & (F.col("score_lex") >= 0.85), MISSPELT_SCORE).otherwise(F.col("score_lex")), "normalized_surface": F.when(miss, SPELT)})


def _fuzzy_score(a: Column, b: Column, low: Column, high: Column) -> Column:
    ratio = 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    return F.round(F.least(high, F.greatest(low, low + (high - low) * ratio)), 4)


def fuzzy_pairs(queries: DataFrame, surfaces: DataFrame) -> DataFrame:
    """(norm, surface): distinct strings within one Damerau edit of each other when joiners are stripped, or of 90 % similarity.

    Pairs within one edit share a string of the ≤1-deletion neighbourhood, so they meet in an equi-join. Similarity alone adds
    pairs from 20 characters on; k edits of 10 k characters leave six in a row whole, so those meet on runs of six.
    """
    q = queries.select("norm").distinct().withColumn("qs", X.strip_joiners(F.col("norm")))
    k = surfaces.select("surface").distinct().withColumn("ks", X.strip_joiners(F.col("surface")))
    near = q.withColumn("d", F.explode(X.deletions(F.col("qs")))).join(k.withColumn("d", F.explode(X.deletions(F.col("ks")))), "d").drop("d").distinct()
    near = near.where(X.within_one_edit(F.col("qs"), F.col("ks")))
    long_q, long_k = q.where(F.length("qs") >= 18), k.where(F.length("ks") >= 18)
    grams = lambda c: F.transform(F.sequence(F.lit(1), F.length(c) - 5), lambda i: F.substring(c, i, F.lit(6)))
    far = long_q.withColumn("g", F.explode(F.array_distinct(grams(F.col("qs"))))).join(long_k.withColumn("g", F.explode(F.array_distinct(grams(F.col("ks"))))), "g").drop("g").distinct()
    far = far.where(1 - F.levenshtein("qs", "ks") / F.greatest(F.length("qs"), F.length("ks")) >= 0.9)
    return near.unionByName(far).where("norm <> surface").select("norm", "surface").distinct()


def fuzzy(words_: DataFrame, surfaces: DataFrame, hebrew_only: bool = True) -> DataFrame:
    """Words without an exact match and their first fuzzy surface; hebrew_only limits the surfaces to those with Hebrew letters."""
    keys = surfaces.where(F.col("surface").rlike(rf"[{X.HE}]")) if hebrew_only else surfaces
    asked = words_.where(~F.col("norm").rlike(r"^\d+$"))
    found = _best(fuzzy_pairs(asked, keys).join(keys, "surface"), ["norm"], "seq")
    found = found.withColumns({"match_type": F.lit("fuzzy"), "score_lex": _fuzzy_score(F.col("norm"), F.col("surface"), F.lit(FUZZY_LOW), F.lit(FUZZY_HIGH))}).drop("surface")
    return asked.join(found, "norm").withColumn("normalized_surface", F.lit(None).cast("string"))


def phonetic(words_: DataFrame, surfaces: DataFrame) -> DataFrame:
    """ASCII words whose sound code is that of a surface of letters."""
    coded = surfaces.where(F.col("surface").rlike(r"^[A-Za-z ]*[A-Za-z][A-Za-z ]*$")).withColumn("code", X.phonetic(F.col("surface"))).where("code <> ''")
    first = _best(coded, ["code"], "seq").drop("surface")
    asked = words_.where(F.col("text").rlike("^[A-Za-z]+$")).withColumn("code", X.phonetic(F.col("text"))).where("code <> ''")
    return asked.join(first, "code").drop("code").withColumns({"match_type": F.lit("phonetic"), "score_lex": F.lit(PHONETIC), "normalized_surface": F.lit(None).cast("string")})


def chunks(tokens: DataFrame, covered: DataFrame, keys: list[str], most: int = NGRAM_MAX) -> DataFrame:
    """(keys, run, chunk, idxs, s, e, surf): uncovered words in maximal runs of neighbours, cut to `most` words.

    Longest-first windows that cover what they try, matched or not, end as just these cuts.
    """
    free = words(tokens).join(covered.select(*keys, "idx").distinct(), [*keys, "idx"], "left_anti")
    w = Window.partitionBy(*keys).orderBy("idx")
    runs = free.withColumn("run", F.col("idx") - F.row_number().over(w))
    place = F.row_number().over(Window.partitionBy(*keys, "run").orderBy("idx")) - 1
    cut = runs.withColumn("chunk", F.floor(place / most).cast("int"))
    out = cut.groupBy(*keys, "run", "chunk").agg(F.array_sort(F.collect_list(F.struct("idx", "norm"))).alias("w"), F.min("s").alias("s"), F.max("e").alias("e"))
    return out.withColumn("surf", F.array_join(F.transform("w", lambda x: x["norm"]), " ")).withColumn("idxs", F.transform("w", lambda x: x["idx"]))


def window_matches(chunked: DataFrame, surfaces: DataFrame, keys: list[str]) -> DataFrame:
    """The surface inside each chunk that starts first, then is longest; the match spans the chunk."""
    n = F.size("w")
    parts = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(F.sequence(F.lit(1), n - i), lambda k: F.struct(i.alias("at"), k.alias("n"), F.array_join(F.transform(F.slice(F.col("w"), i + 1, k), lambda x: x["norm"]), " ").alias("part")))))
    inside = chunked.select(*keys, "run", "chunk", F.explode(parts).alias("p")).select(*keys, "run", "chunk", "p.at", "p.n", "p.part")
    hit = inside.join(surfaces, F.col("part") == F.col("surface")).drop("surface", "part")
    return chunked.join(_best(hit, [*keys, "run", "chunk"], "at", F.desc("n"), "seq").drop("at", "n"), [*keys, "run", "chunk"])


def window_fuzzy(chunked: DataFrame, surfaces: DataFrame) -> DataFrame:
    """Chunks without a surface inside and up to three near ones of the whole chunk, best first; short chunks have a wider band."""
    asked = chunked.withColumnRenamed("surf", "norm")
    pairs = fuzzy_pairs(asked, surfaces).join(surfaces, "surface")
    short = F.length("norm") <= 4
    scored = pairs.withColumns({"match_type": F.lit("fuzzy"), "score_lex": _fuzzy_score(F.col("norm"), F.col("surface"), F.when(short, SHORT_LOW).otherwise(FUZZY_LOW), F.when(short, SHORT_HIGH).otherwise(FUZZY_HIGH))})
    best = scored.withColumn("_n", F.row_number().over(Window.partitionBy("norm").orderBy(F.desc("score_lex"), "seq"))).where("_n <= 3").drop("_n", "surface")
    return asked.join(best, "norm").withColumnRenamed("norm", "surf")


def first_by_span(matches: DataFrame, keys: list[str]) -> DataFrame:
    """One match a span: of the token pass, then the window pass, in order of the lexicon. Spans here are equal or apart."""
    return _best(matches, [*keys, "s", "e"], "pass", "seq")


def drop_placeholders(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Placeholders go where the same span has a resolved concept."""
    real = F.max(F.startswith("iri", F.lit("http://")).cast("int")).over(Window.partitionBy(*keys, "s", "e"))
    held = F.lit(False)
    for p in PLACEHOLDERS:
        held = held | F.startswith("iri", F.lit(p))
    return matches.withColumn("_real", real).where(~(held & (F.col("_real") == 1))).drop("_real")


def without_numbers(matches: DataFrame, tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Matches whose label is no number and whose span touches no number, pair or unit."""
    hard = tokens.where(F.col("kind").isin("number", "pair", "unit")).select(*keys, F.col("s").alias("_s"), F.col("e").alias("_e"))
    m, h = matches.alias("m"), hard.alias("h")
    on = [F.col(f"m.{k}") == F.col(f"h.{k}") for k in keys] + [F.col("h._s") < F.col("m.e"), F.col("h._e") > F.col("m.s")]
    return m.where(~F.col("label").rlike(r"^\d+$")).join(h, on, "left_anti")


def hints(surface: Column) -> Column:
    low = F.lower(surface)
    found = [F.when(F.exists(F.array(*map(F.lit, ws)), lambda w: F.contains(low, w)), name) for name, ws in HINTS] + [F.when(low.isin(*ws), name) for name, ws in WHOLE_HINTS]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def word_frequencies(tokens: DataFrame) -> DataFrame:
    """(norm, freq, share): words of three characters or more and their count, as a share of the most frequent one's.

    Tokens are counted as they are written first; kind and normal form are found once for each distinct one.
    """
    raw = tokens.groupBy("text").agg(F.count("*").alias("freq")).where(X.token_kind(F.col("text")) == "word")
    normed = raw.select(X.normalize_hebrew(F.lower("text")).alias("norm"), "freq").groupBy("norm").agg(F.sum("freq").alias("freq"))
    counts = stored(normed.where((F.length("norm") > 2) & ~F.col("norm").rlike(r"^\d+$")), "frequencies")
    top = counts.agg(F.max("freq").alias("top"))  # one row
    return counts.crossJoin(F.broadcast(top)).select("norm", "freq", (F.col("freq") / F.col("top")).alias("share"))


def priors(matches: DataFrame, tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Adds score_prior: the mean share of the words that a match covers (0 without any)."""
    shares = words(tokens).join(word_frequencies(tokens), "norm").select(*keys, F.col("idx").alias("_i"), "share")
    spread = matches.select(*keys, "s", "e", F.explode("idxs").alias("_i")).distinct()
    mean = spread.join(shares, [*keys, "_i"]).groupBy(*keys, "s", "e").agg(F.round(F.avg("share"), 4).alias("score_prior"))
    return matches.join(mean, [*keys, "s", "e"], "left").withColumn("score_prior", F.coalesce("score_prior", F.lit(0.0)))


def gazetteer(tokens: DataFrame, surfaces: DataFrame, keys: list[str]) -> DataFrame:
    """All lexical matches: (keys, mention_id, s, e, idxs, seq, iri, label, match_type, score_lex, iri_source, hints, score_prior)."""
    tokens, surfaces = stored(tokens, "tokens"), stored(surfaces, "surfaces")
    w = words(tokens)
    got = stored(exact(w, surfaces), "exact")
    left = w.join(got.select(*keys, "idx").distinct(), [*keys, "idx"], "left_anti")
    near = stored(fuzzy(left, surfaces), "fuzzy")
    left = left.join(near.select(*keys, "idx").distinct(), [*keys, "idx"], "left_anti")
    sound = phonetic(left, surfaces)
    single = stored(got.unionByName(near).unionByName(sound).select(*keys, "idx", "s", "e", *_META), "single")
    one = single.select(*keys, "s", "e", F.array("idx").alias("idxs"), *_META, F.lit(0).alias("pass"))
    chunked = stored(chunks(tokens, single, keys), "chunks")
    inside = stored(window_matches(chunked, surfaces, keys), "inside")
    rest = chunked.join(inside.select(*keys, "run", "chunk"), [*keys, "run", "chunk"], "left_anti")
    many = inside.select(*keys, "s", "e", "idxs", *_META).unionByName(window_fuzzy(rest, surfaces).select(*keys, "s", "e", "idxs", *_META)).withColumn("pass", F.lit(1))
    hits = stored(first_by_span(drop_placeholders(one.unionByName(many), keys), keys).drop("pass"), "hits")
    hits = priors(without_numbers(hits, tokens, keys), tokens, keys)
    mention = F.concat_ws("_", F.concat(F.lit("m"), F.concat_ws(".", *keys)), "s", "e")
    return hits.withColumns({"mention_id": mention, "hints": hints(F.col("label"))})


def coverage(tokens: DataFrame, hits: DataFrame) -> DataFrame:
    """One row: tokens, covered tokens, their ratio, mentions."""
    covered = hits.agg(F.coalesce(F.sum(F.size("idxs")), F.lit(0)).alias("covered_tokens"), F.count("*").alias("mentions"))
    total = tokens.agg(F.count("*").alias("total_tokens"))
    ratio = F.when(F.col("total_tokens") > 0, F.round(F.col("covered_tokens") / F.col("total_tokens"), 4)).otherwise(F.lit(0.0))
    return total.crossJoin(covered).select("total_tokens", "covered_tokens", ratio.alias("coverage_ratio"), "mentions")
