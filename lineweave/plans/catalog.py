"""Queries of the text and linking operators over whole tables, one an operator or group of them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import assist, lexicon, match, rank, report, review, vector
from ..operators.normalize import normalize, only
from ..operators.tokenize import neighbours, of_kind, tokens, with_tokens
from ..sources import tables
from ..sources.durable import measured, numbered, shared_folder, sliced, sparing, stored
from ..sources.tables import lines_of, table
from . import linking, text_stage

#: Letters that stand for a to z in notes made from part names.
LATIN, HEBREW = "abcdefghijklmnopqrstuvwxyz", "אבגדהוזחטיכלמנסעפצקרשתםןףץ"
CORE = {"type": "type", "label": "label", "synonym": "synonym", "definition": "definition"}


# --- inputs -------------------------------------------------------------------------------------------------------------


def notes(spark: SparkSession, d: str) -> DataFrame:
    """(key, raw_text): short mixed-script notes made from part and lineitem: glued numbers, a pair, a glued unit."""
    li, part = table(spark, d, "lineitem"), table(spark, d, "part")
    both = li.join(part, li.l_partkey == part.p_partkey)
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd"))
    raw = F.concat(F.translate(F.split_part("p_name", F.lit(" "), F.lit(2)), LATIN, HEBREW), F.col("p_size").cast("string"), F.lit(" "), F.col("l_linenumber").cast("string"), F.lit("/"), F.col("l_quantity").cast("int").cast("string"), F.lit(" "), F.col("p_size").cast("string"), F.lit("ממ"))
    return both.select(key.alias("key"), raw.alias("raw_text"), "l_linenumber", "p_size")


def doc_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines_of(table(spark, d, "documents"), "doc_id", "text")


def all_lines(spark: SparkSession, d: str) -> DataFrame:
    """(key, raw_text): lines of documents and notes."""
    docs = doc_lines(spark, d).select(F.concat_ws(".", F.lit("d"), "doc_id", "line_no").alias("key"), "raw_text")
    return docs.unionByName(notes(spark, d).select("key", "raw_text"))


def normalized(spark: SparkSession, d: str) -> DataFrame:
    return normalize(all_lines(spark, d))


def talk(spark: SparkSession, d: str) -> DataFrame:
    return tokens(table(spark, d, "conversations"), ["conv_id", "turn"], "text")


TALK = ["conv_id", "turn"]


def triples(spark: SparkSession, d: str) -> DataFrame:
    """(subj, pred, obj, lang, literal) made from region, nation and part."""
    region, nation, part = (table(spark, d, t) for t in ("region", "nation", "part"))
    row = lambda df, s, p, o, lang=None, lit=True: df.select(s.alias("subj"), F.lit(p).alias("pred"), o.alias("obj"), F.lit(lang).cast("string").alias("lang"), F.lit(lit).alias("literal"))
    r, n, p = (F.concat(F.lit(x), F.col(c).cast("string")) for x, c in (("R:", "r_regionkey"), ("N:", "n_nationkey"), ("P:", "p_partkey")))
    of_nation = F.concat(F.lit("R:"), F.col("n_regionkey").cast("string"))
    parts = [
        row(region, r, "label", F.initcap("r_name"), "en"), row(region, r, "type", F.lit("Region"), None, False), row(region, r, "definition", F.concat(F.lit("region "), F.lower("r_name"))),
        row(nation, n, "label", F.col("n_name"), "fr"), row(nation, n, "label", F.lower("n_name"), "de"), row(nation, n, "synonym", F.replace("n_name", F.lit("_"), F.lit(" "))), row(nation, n, "type", F.lit("Nation"), None, False), row(nation, n, "part_of", of_nation, None, False),
        row(part, p, "label", F.col("p_name"), "en"), row(part, p, "label", F.upper("p_name"), "en"), row(part, p, "synonym", F.concat_ws(" ", "p_name", F.lower("p_type"))), row(part, p, "type", F.col("p_type"), None, False), row(part, p, "brand", F.col("p_brand")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def entries(spark: SparkSession, d: str) -> DataFrame:
    """(seq, iri, label, synonyms, definition): a lexicon of the words of benchmark, four letters and more, and of its items' first two words."""
    words = table(spark, d, "benchmark").select(F.explode(F.array_distinct(X.find_all(F.lower("text"), "([a-z]{4,})"))).alias("label")).distinct()
    pairs = table(spark, d, "benchmark").select(F.lower(F.regexp_extract("text", r"^([A-Za-z]+ [A-Za-z]+)", 1)).alias("label")).where("label <> ''").distinct()
    both = words.unionByName(pairs).distinct()
    reverse = F.when(F.length("label") % 3 == 0, F.array(F.reverse("label"))).otherwise(F.array().cast("array<string>"))
    return numbered(both, "label").select("seq", F.concat(F.lit("W:"), "label").alias("iri"), "label", reverse.alias("synonyms"), F.lit("").alias("definition"))


def surfaces(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.dedupe_surfaces(lexicon.lexicon_surfaces(entries(spark, d)))


def ascii_words(spark: SparkSession, d: str) -> DataFrame:
    return match.words(talk(spark, d)).where(F.col("text").rlike("^[A-Za-z]+$"))


def one_a_line(spark: SparkSession, d: str) -> DataFrame:
    """Lineitem with one row for each line number of an order."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax").groupBy("l_orderkey", "l_linenumber").agg(*(F.max(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")))


def named(li: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    return li.join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


def ranked_inputs(spark: SparkSession, d: str, li: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(mentions, lexical candidates, vector spans, vector candidates) by line, made from lineitem (or from li, some of its lines, named): a mention a
    line, vectors beside it."""
    li = named(one_a_line(spark, d), spark, d) if li is None else li
    start, key = (F.col("l_linenumber") * 20).cast("int"), F.col("l_orderkey").alias("line_id")
    mention = F.concat(F.lit("m"), F.col("l_linenumber").cast("string"))
    mentions = li.select(key, mention.alias("mention_id"), F.col("p_name").alias("surface"), start.alias("s"), (start + F.length("p_name")).cast("int").alias("e"))
    prefix = F.when(F.col("l_partkey") % 3 == 0, lexicon_prefix("OHD_")).when(F.col("l_partkey") % 3 == 1, lexicon_prefix("FMA_")).otherwise(F.lit("DEVICE:"))
    iri = F.concat(prefix, (F.col("l_partkey") % 40).cast("string"))
    source = F.when(F.col("l_suppkey") % 4 == 0, "ohd_label").when(F.col("l_suppkey") % 4 == 1, "ohd_synonym").when(F.col("l_suppkey") % 4 == 2, "alias_only").otherwise("resolved_alias")
    lexical = li.select(key, mention.alias("mention_id"), iri.alias("iri"), F.col("p_name").alias("label"), F.round(F.lit(1.0) - F.col("l_discount") * 2, 2).alias("score_lex"), F.col("l_tax").alias("score_prior"), source.alias("iri_source"), F.lit(0).cast("long").alias("seq"))
    word = F.split_part("p_name", F.lit(" "), (F.col("l_suppkey") % 2 + 1).cast("int"))
    vec = li.select(key, F.concat(F.lit("v"), F.col("l_linenumber").cast("string")).alias("vec_id"), F.when(F.col("l_suppkey") % 5 == 0, "zzz").otherwise(word).alias("surface"), F.when(F.col("l_suppkey") % 10 == 0, F.lit(0)).otherwise(start + 7).cast("int").alias("s"), F.when(F.col("l_suppkey") % 10 == 0, F.lit(0)).otherwise(start + 12).cast("int").alias("e"), F.col("l_partkey"), F.col("l_quantity"), iri.alias("iri"))
    n = F.explode(F.sequence(F.lit(0), F.lit(2)))
    cands = vec.select("line_id", "vec_id", "iri", "l_partkey", "l_quantity", n.alias("n")).select("line_id", "vec_id", F.when(F.col("n") == 0, F.col("iri")).otherwise(F.concat(lexicon_prefix("OHD_"), ((F.col("l_partkey") + F.col("n") * 7) % 40).cast("string"))).alias("iri"), F.concat(F.lit("c"), F.col("n").cast("string")).alias("label"), F.round((F.col("l_quantity") + F.col("n") * 13) % 50 / 50, 2).alias("score_vec"), F.col("n").cast("long").alias("seq"))
    return mentions, lexical, vec.select("line_id", "vec_id", "surface", "s", "e"), cands


def lexicon_prefix(name: str):
    return F.lit(f"http://purl.obolibrary.org/obo/{name}")


KEY = ["line_id"]


def merged(spark: SparkSession, d: str, li: DataFrame | None = None) -> DataFrame:
    mentions, lexical, spans, cands = ranked_inputs(spark, d, li)
    to = rank.attach(mentions, spans, KEY)
    found = cands.join(to, [*KEY, "vec_id"]).select(*KEY, "mention_id", "iri", "label", "score_vec", "seq")
    return rank.merge_candidates(lexical, found, KEY)


def ranked(spark: SparkSession, d: str) -> DataFrame:
    return rank.rank(rank.score(merged(spark, d), KEY), KEY)


def op_lines(spark: SparkSession, d: str) -> DataFrame:
    """Notes of the first line numbers with edits derived from their keys."""
    lines = with_tokens(normalize(notes(spark, d), compose=False))
    a, b = (F.col("l_linenumber") % 6 - 1).cast("int"), (F.col("p_size") % 5).cast("int")
    none = F.lit(None).cast("int")
    ops = F.array(F.struct(F.lit("insert_space").alias("op"), a.alias("after_idx"), none.alias("first"), none.alias("last")), F.struct(F.when(F.col("p_size") % 11 == 0, "erase").otherwise("merge_tokens").alias("op"), none.alias("after_idx"), b.alias("first"), (b + F.col("l_linenumber") % 3 - 1).cast("int").alias("last")))
    return lines.withColumn("ops", ops)


# --- queries ------------------------------------------------------------------------------------------------------------


def line_source(s, d):
    return doc_lines(s, d)


def n0_spacing(s, d):
    return X.spaced_steps(all_lines(s, d), "raw_text", "spaced", "said").select("key", "spaced", F.array_join("said", ";").alias("notes"))


def n0_pairs(s, d):
    p = normalized(s, d).select("key", F.posexplode_outer("pairs").alias("n", "p")).where("n is not null")
    return p.select("key", "n", "p.text", "p.a", "p.b", "p.sep", "p.s", "p.e")


def n0_numbers(s, d):
    return only(normalized(s, d).select("key", F.array_join("numbers", ",").alias("numbers")), "numbers <> ''", "key", "numbers")


def n0_units(s, d):
    return only(normalized(s, d).select("key", "normalized_text", F.array_join("units_found", ",").alias("units")), "units <> ''", "key", "normalized_text", "units")


def stamps(s, d):
    return table(s, d, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" "), F.date_format("ts", "dd/MM/yy h.mm"), F.lit(" PM")).alias("raw_text"))


def n0_dates(s, d):
    return normalize(stamps(s, d), compose=False).select("event_id", F.array_join("dates", ",").alias("dates")).unionByName(only(normalized(s, d).select(F.lit(None).cast("long").alias("event_id"), F.array_join("dates", ",").alias("dates")), "dates <> ''", "event_id", "dates"))


def n0_times(s, d):
    return normalize(stamps(s, d), compose=False).select("event_id", F.array_join("times", ",").alias("times"))


def n0_nfc(s, d):
    docs = table(s, d, "documents")
    return docs.select("doc_id", F.md5(X.nfc(F.col("text"))).alias("composed"))


def t1_tokens(s, d):
    return tokens(normalize(doc_lines(s, d)), ["doc_id", "line_no"]).select("doc_id", "line_no", "idx", "text", "kind", "script", "s", "e")


def t1_kind_counts(s, d):
    return tokens(normalized(s, d), ["key"]).groupBy("kind", "script").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.sum(F.col("s").cast("long") * (F.col("idx") + 1)).alias("mark"))


def t1_pairs_view(s, d):
    return of_kind(tokens(normalized(s, d), ["key"]), "pair").select("key", "idx", "text", "a", "b", "sep")


def marked_view(s, d):
    return review.marked_view(with_tokens(normalize(notes(s, d).select("key", "raw_text")))).select("key", "view")


def validate_ops(s, d):
    return review.validate(op_lines(s, d)).select("key", F.array_join("errors", ";").alias("errors"), "valid")


def apply_ops(s, d):
    return review.digit_check(review.apply_ops(op_lines(s, d)), "normalized_text", "edited").select("key", "edited", "digit_mismatch")


def term_cleanup(s, d):
    terms = F.array(F.col("p_name"), F.upper("p_name"), F.lit(" "), F.concat_ws(" ", "p_type", F.col("p_size").cast("string")), F.lower("p_type"), F.initcap("p_type"))
    return table(s, d, "part").select("p_partkey", F.array_join(review.clean_terms(terms), ";").alias("terms"), F.array_join(review.guard_terms(F.array(F.concat(F.lit(" "), "p_name"), F.col("p_brand"), F.col("p_type"), F.concat_ws("  ", "p_type", "p_name"), F.lit("-x"), F.lit("last"))), ";").alias("guarded"))


def hint_join(s, d):
    t = talk(s, d).select(*TALK, "idx", "text")
    turns = table(s, d, "conversations")
    group = lambda n: F.concat(F.lit("g"), ((F.col("conv_id") + n) % 4).cast("string"))
    hint = lambda n: turns.select(*TALK, ((F.col("turn") + n * (F.col("conv_id") % 2)) % 5 * F.lit(9)).cast("int").alias("idx"), F.lit(n).alias("seq"), F.concat(F.lit("h"), F.lit(str(n))).alias("hint"), group(n).alias("tooth_group"))
    groups = table(s, d, "region").select(F.concat(F.lit("g"), F.col("r_regionkey").cast("string")).alias("tooth_group"), F.col("r_name").alias("fdi")).where("tooth_group < 'g3'")
    return review.attach_hints(t, hint(1).unionByName(hint(2)), groups, TALK)


def lexicon_build(s, d):
    return lexicon.lexicon(triples(s, d)).select("iri", "label", F.array_join("synonyms", ";").alias("synonyms"), "definition")


def nodes_full(s, d):
    shown = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], "|"))), ";")
    n = lexicon.nodes(triples(s, d), CORE)
    return n.select("iri", F.array_join("types", ";").alias("types"), "label", shown("labels").alias("labels"), F.array_join("synonyms", ";").alias("synonyms"), F.array_join("definitions", ";").alias("definitions"), shown("annotations").alias("annotations"))


def edges(s, d):
    return lexicon.edges(triples(s, d), CORE)


def embed_text(s, d):
    return lexicon.embedding_text(lexicon.lexicon(triples(s, d))).select("iri", "text")


def gazetteer_surfaces(s, d):
    lex = numbered(lexicon.lexicon(triples(s, d)), "iri")
    brands = table(s, d, "part").select(F.col("p_partkey").alias("seq"), F.col("p_brand").alias("key"), F.concat_ws(" ", "p_brand", "p_type").alias("value"))
    return lexicon.lexicon_surfaces(lex).unionByName(lexicon.dictionary_surfaces(brands, "BRAND", "brand_synonym", "synonym", lexicon.SYNONYM, label_is_key=True))


def gaz_dedupe(s, d):
    return lexicon.dedupe_surfaces(gazetteer_surfaces(s, d)).select("surface", "iri", "label", "match_type", "score_lex")


def resolve_alias(s, d):
    a = table(s, d, "benchmark").select(F.explode(F.array_distinct(X.find_all(F.lower("text"), "([a-z]+)"))).alias("alias")).unionByName(table(s, d, "nation").select(F.col("n_name").alias("alias"))).unionByName(entries(s, d).select(F.reverse("label").alias("alias")))
    return lexicon.resolve(a, entries(s, d))


def gaz_exact(s, d):
    return match.exact(match.words(talk(s, d)), surfaces(s, d)).select(*TALK, "idx", "norm", "iri", "match_type", "score_lex")


def gaz_phonetic(s, d):
    return match.phonetic(match.words(talk(s, d)), surfaces(s, d)).select(*TALK, "idx", "text", "iri", "match_type", "score_lex")


def gaz_fuzzy(s, d):
    return match.fuzzy(ascii_words(s, d), surfaces(s, d), hebrew_only=False).select(*TALK, "idx", "norm", "iri", "score_lex")


def gaz_chunks(s, d):
    t = talk(s, d)
    return match.chunks(t, match.exact(match.words(t), surfaces(s, d)), TALK).select(*TALK, "run", "chunk", "s", "e", "surf", F.array_join("idxs", ",").alias("idxs"))


def gaz_ngram(s, d):
    t = talk(s, d)
    return match.window_matches(match.chunks(t, t.where("false"), TALK), surfaces(s, d), TALK).select(*TALK, "run", "chunk", "s", "e", "iri", "match_type", "score_lex")


def gazetteer_hits(s, d):
    hits = match.gazetteer(talk(s, d), surfaces(s, d), TALK)
    return hits.select("mention_id", *TALK, "s", "e", "iri", "match_type", "score_lex", F.array_join("hints", ",").alias("hints"), F.round("score_prior", 3).alias("score_prior"))


def gaz_window_fuzzy(s, d):
    t = talk(s, d)
    words = match.words(t).groupBy("norm").agg(F.count("*").alias("n")).select(F.col("norm").alias("surf"), "n")
    return match.window_fuzzy(words, surfaces(s, d)).select("surf", "n", "iri", "score_lex")


def gaz_priors(s, d):
    t = talk(s, d)
    hits = match.exact(match.words(t), surfaces(s, d)).select(*TALK, "s", "e", F.array("idx").alias("idxs"), "iri")
    return match.priors(hits, t, TALK).select(*TALK, "s", "e", "iri", F.round("score_prior", 3).alias("score_prior"))


def gaz_build(s, d):
    """Surfaces of all kinds of dictionaries, made from part, nation and supplier."""
    s = measured(s)
    part, nation = table(s, d, "part"), table(s, d, "nation")
    pair = lambda df, seq, key, value: df.select(seq.cast("long").alias("seq"), key.alias("key"), value.alias("value"))
    brands = pair(part, F.col("p_partkey"), F.col("p_brand"), F.concat_ws(" ", "p_brand", "p_type"))
    abbreviations = pair(nation, F.col("n_nationkey"), F.concat(F.lit("ab"), F.col("n_nationkey").cast("string")), F.col("n_name"))
    mapped = F.when(F.col("n_nationkey") % 3 == 0, lexicon_prefix("OHD_9")).otherwise(F.concat(F.lit("DEVICE:"), F.col("n_nationkey").cast("string")))
    aliases = nation.select(F.col("n_nationkey").cast("long").alias("seq"), F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.concat(F.lit("9q9"), "n_name", F.lit("9q9"))).alias("alias"), mapped.alias("mapped"))
    he2en = pair(part.where("p_partkey <= 50"), F.col("p_partkey"), F.translate(F.split_part("p_name", F.lit(" "), F.lit(1)), LATIN, HEBREW), F.concat(F.split_part("p_name", F.lit(" "), F.lit(1)), F.when(F.col("p_partkey") % 2 == 0, "9q9").otherwise(""), F.col("p_partkey").cast("string")))
    got = lexicon.build_surfaces(numbered(lexicon.lexicon(triples(s, d)), "iri"), abbreviations, brands, aliases, he2en)
    return got.select("surface", "iri", "label", "match_type", "score_lex", "iri_source")


def hebrew_text(s, d):
    n = notes(s, d)
    return n.select("key", X.normalize_hebrew(F.col("raw_text")).alias("norm"), X.is_mostly_hebrew(F.col("raw_text")).alias("hebrew"), X.is_mostly_hebrew(F.concat(F.lit("ab"), F.split_part("raw_text", F.lit(" "), F.lit(1)))).alias("mixed"))


def fdi_rule(s, d):
    fdi = F.array(F.col("p_size").cast("string"), (F.col("p_partkey") % 90).cast("string"))
    lines = table(s, d, "part").select("p_partkey", fdi.alias("fdi"), F.col("p_name").alias("normalized_text"), F.array().cast("array<struct<idx:int,text:string,kind:string>>").alias("tokens"), F.array().cast(review.OPS).alias("ops"))
    known = F.transform(F.sequence(F.lit(11), F.lit(48)), lambda i: i.cast("string"))
    return review.validate(lines, fdi_col="fdi", valid_fdi=known).select("p_partkey", F.array_join("errors", ";").alias("errors"), "valid")


def op_survivors(s, d):
    done = review.apply_ops(op_lines(s, d)).withColumn("after", F.regexp_replace("edited", r"\d$", ""))
    return review.survivors(done.withColumn("after", F.replace("after", F.lit("1"), F.lit(""))), "after").select("key", F.array_join("missing", ";").alias("missing"))


def hint_prompt(s, d):
    return review.hint_prompt(review.marked_view(with_tokens(normalize(notes(s, d).select("key", "raw_text"))))).select("key", F.md5("hint_prompt").alias("prompt"))


def text_merged(s, d):
    return text_stage.run(notes(s, d).select("key", "raw_text"), ["key"]).select("key", "normalized_text", F.size("tokens").alias("n_tokens"), F.size("pairs").alias("n_pairs"), F.size("numbers").alias("n_numbers"))


def placeholder_suppress(s, d):
    mentions, lexical, _, _ = ranked_inputs(s, d)
    both = lexical.join(mentions.select(*KEY, "mention_id"), [*KEY, "mention_id"]).withColumns({"s": F.lit(0), "e": F.col("seq").cast("int") + 1})
    return match.drop_placeholders(both, KEY).select(*KEY, "mention_id", "iri")


def span_filter(s, d):
    t = tokens(normalized(s, d), ["key"])
    m = t.select("key", F.col("s"), (F.col("e") + 1).alias("e"), F.col("text").alias("label"))
    return match.without_numbers(m, t, ["key"]).groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("s") + F.col("e")).alias("mark"))


def surface_hints(s, d):
    p = table(s, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.when(F.col("p_size") % 3 == 0, "Implant").when(F.col("p_size") % 3 == 1, "zirconia caries").otherwise("plain")).alias("surface"))
    return p.select("p_partkey", F.array_join(match.hints(F.col("surface")), ",").alias("hints"))


def freq_prior(s, d):
    return match.word_frequencies(tokens(doc_lines(s, d), ["doc_id", "line_no"], "raw_text")).select("norm", "freq", F.round("share", 6).alias("share"))


def coverage_stats(s, d):
    t = talk(s, d)
    hits = match.exact(match.words(t), surfaces(s, d)).select(F.array("idx").alias("idxs"))
    return match.coverage(t, hits)


def vec_topk(s, d):
    e = table(s, d, "embeddings")
    hits = vector.top_k(e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q")), e.select(F.col("vec_id").alias("iri"), "embedding"), 10)
    return hits.select("qid", "iri", F.round("score_raw", 6).alias("score_raw"), "rank")


def vec_rerank(s, d):
    e = table(s, d, "embeddings")
    scaled = F.transform("embedding", lambda x: x * (F.col("vec_id") % 3 + 1).cast("float"))
    hits = vector.rerank(vector.top_k(e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("q")), e.select(F.col("vec_id").alias("iri"), scaled.alias("embedding")), 10))
    return hits.select("qid", "iri", F.round("score_cos", 5).alias("score_cos"), "rank")


def vec_context(s, d):
    near = neighbours(talk(s, d), TALK)
    return vector.candidate_tokens(near).select(*TALK, "idx", F.array_join("context", " ").alias("context"), vector.query_text(F.col("text"), F.col("context"), F.lit(None).cast("array<string>"), F.lit(None).cast("string")).alias("query"))


def vec_hist(s, d):
    return vector.timing_histogram(table(s, d, "events"), "value")


def lengths_encoder(texts: list[str]):
    """Characters, spaces and one: an encoder that SQL can express, too."""
    import numpy as np

    return np.array([[len(t), t.count(" "), 1.0] for t in texts]).reshape(-1, 3)


def vec_encode(s, d):
    t = vector.encode(lexicon.embedding_text(lexicon.lexicon(triples(s, d))), "text", lengths_encoder, normalize=True)
    return t.select("iri", *(F.round(F.col("embedding")[i].cast("double"), 4).alias(n) for i, n in enumerate(("chars", "spaces", "one"))))


def hybrid_attach(s, d):
    mentions, _, spans, _ = ranked_inputs(s, d)
    return rank.attach(mentions, spans, KEY)


def hybrid_fresh(s, d):
    mentions, _, spans, _ = ranked_inputs(s, d)
    return rank.fresh_mentions(mentions, spans, rank.attach(mentions, spans, KEY), KEY).select(*KEY, "vec_id")


def hybrid_score(s, d):
    return rank.score(merged(s, d), KEY).select(*KEY, "mention_id", "iri", F.round("norm_vec", 6).alias("norm_vec"), F.round("score_final", 6).alias("score_final"))


def hybrid_rank(s, d):
    return ranked(s, d).select(*KEY, "mention_id", "iri", F.round("score_final", 6).alias("score_final"), "rank", "confident")


def select_top1(s, d):
    mentions = ranked_inputs(s, d)[0]
    return rank.select_top(mentions, ranked(s, d), KEY).select(*KEY, "mention_id", "surface", "s", "e", "iri", F.round("score_final", 6).alias("score_final"), "confident")


def bundles(s, d):
    mentions = ranked_inputs(s, d)[0]
    top = rank.select_top(mentions, ranked(s, d), KEY)
    near = top.withColumns({"s": (F.col("s") / 20).cast("int"), "e": (F.col("s") / 20).cast("int") + 1, "iri": F.when(F.col("line_id") % 2 == 0, F.lit("DEVICE:1")).otherwise(F.col("iri")), "surface": F.concat_ws(" ", "surface", F.when(F.col("line_id") % 4 == 0, "4mm"))})
    return rank.bundle(near, KEY).select(*KEY, "mention_id", "iri", "s", "e", "surface", "bundle")


def rescue_gate(s, d):
    t = talk(s, d)
    lex = match.exact(match.words(t), surfaces(s, d)).where("match_type = 'synonym'")
    return assist.unmatched(table(s, d, "conversations").select(*TALK), lex, lex.where("false"), TALK)


def rescue_terms(s, d):
    p = table(s, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.when(F.col("p_size") % 4 == 0, "IMPLANT").when(F.col("p_size") % 4 == 1, "multi unit")).alias("raw_text"))
    return assist.rescue(p).select("p_partkey", F.array_join("canonical_terms", ";").alias("terms"))


def line_stats(s, d):
    n0 = normalize(notes(s, d))
    return report.line_stats(n0, tokens(n0, ["key"]))


def lexicon_gap(s, d):
    return report.lexicon_gap(entries(s, d), match.words(talk(s, d)).select(F.col("norm").alias("surface")).distinct()).select("iri", "label")


#: Rows of lineitem whose candidates are held against a grid at a time. What is on disk at once is the lines and the shuffles of so many of them.
GRID_LINES = 4_000_000


def grid_search(s, d, most: int = GRID_LINES):
    """Up to `most` rows of lineitem are one plan; more are graded slice by slice, whole orders each, and the counts are summed."""
    axes = [s.createDataFrame([(x,) for x in xs], f"{n} double") for n, xs in (("w_lex", (0.4, 0.6, 0.8)), ("w_vec", (0.1, 0.2, 0.3)), ("w_prior", (0.0, 0.05, 0.1)))]
    grid = axes[0].crossJoin(axes[1]).crossJoin(axes[2]).withColumn("nth", F.row_number().over(Window.orderBy("w_lex", "w_vec", "w_prior")))
    points = grid.orderBy("nth").collect()
    slices = -(-table(s, d, "lineitem").count() // most)
    run = sparing(s) if slices > 1 else s
    gold = table(run, d, "part").select(F.col("p_name").alias("surface"), F.concat(lexicon_prefix("OHD_"), (F.col("p_partkey") % 40).cast("string")).alias("iri"), F.col("p_partkey").alias("seq"))

    def counts(gold: DataFrame, li: DataFrame | None = None) -> DataFrame:
        scored = rank.score(merged(run, d, li), KEY, use_prior=True)
        cands = scored.join(ranked_inputs(run, d, li)[0].select(*KEY, "mention_id", "surface"), [*KEY, "mention_id"])
        return rank.grid_counts(cands, gold, points, KEY)

    if slices > 1:
        last = stored(gold.groupBy("surface").agg(F.max_by("iri", "seq").alias("iri"), F.max("seq").alias("seq")), "gold")
        lines = sliced(named(stored(one_a_line(run, d), "lines"), run, d), ["l_orderkey"], slices, "named")
        sums = [sum(x) for x in zip(*(counts(last, li).first() for li in lines), strict=True)]  # a row a slice
        total = s.createDataFrame([tuple(sums)], ", ".join(["n long", *(f"p{i} long" for i in range(len(points)))]))
    else:
        total = counts(gold)
    return rank.grid_shares(total, points, grid.schema).select("nth", "w_lex", "w_vec", "w_prior", F.round("accuracy", 6).alias("accuracy"), "n")


def nested_items(s, d):
    k = F.from_json("props", "struct<k:int>")["k"]
    items = F.transform(F.sequence(F.lit(1), k % 3 + 1), lambda i: F.struct((k + i).alias("tooth"), F.array(F.lit("M"), i.cast("string")).alias("surfaces")))
    e = table(s, d, "events").select("event_id", F.when(k % 5 > 0, items).alias("items"))
    return e.select("event_id", F.posexplode_outer("items").alias("n", "i")).select("event_id", "n", "i.tooth", F.array_join("i.surfaces", "/").alias("surfaces"))


def linked_mentions(s, d):
    """The linking plan end to end, with the offline encoder over the lexicon's labels; beyond SQL, tests check it."""
    index = vector.encode(lexicon.embedding_text(entries(s, d)), "text", vector.stub_encoder(), normalize=True).select("iri", "label", "embedding")
    return linking.link(talk(s, d), surfaces(s, d), index, TALK).select(*TALK, "mention_id", "surface", "s", "e", "iri", F.round("score_final", 6).alias("score_final"), "confident")


def linked_lexical(s, d):
    """The linking plan without an index."""
    return linking.link(talk(s, d), surfaces(s, d), None, TALK).select(*TALK, "mention_id", "surface", "s", "e", "iri", F.round("score_final", 6).alias("score_final"), "confident")


def vec_query_terms(s, d):
    """Query texts from canonical terms of some turns and translations of some words."""
    t = talk(s, d)
    turns = table(s, d, "conversations").where("turn % 3 = 0")
    terms = turns.select(*TALK, F.array(F.lit("first"), F.col("conv_id").cast("string"), F.lit("third"), F.lit("fourth")).alias("canonical_terms"))
    he2en = match.words(t).select("text").distinct().where("length(text) = 4").select(F.lit(0).alias("seq"), F.col("text").alias("key"), F.concat(F.lit("en "), "text").alias("value"))
    return linking.queries(t, TALK, terms, he2en).select(*TALK, "idx", "query")


def force_vectors(s, d):
    return rank.needs_vectors(ranked_inputs(s, d)[1], KEY)


def best_point(s, d):
    return rank.best_weights(grid_search(s, d)).select("nth", "w_lex", "w_vec", "w_prior", "accuracy")


def run_summary(s, d):
    n0 = normalize(notes(s, d))
    return report.run_summary(n0, tokens(n0, ["key"]))


def label_sample(s, d):
    return report.label_sample(lexicon.lexicon(triples(s, d))).select("iri", "label")


# --- sources and sinks: written to the shared folder and read back ------------------------------------------------------


def _place(s, name: str) -> str:
    return f"{shared_folder(s)}/lineweave/{name}-{uuid.uuid4().hex}"


def jsonl_files(s, d):
    tables.write_jsonl(table(s, d, "part").select("p_partkey", "p_name", F.array("p_brand", "p_type").alias("tags")), path := _place(s, "jsonl"))
    return tables.read_jsonl(s, path, "p_partkey long, p_name string, tags array<string>").select("p_partkey", "p_name", F.array_join("tags", "|").alias("tags"))


def lexicon_file(s, d):
    """A lexicon of one file, a fifth of its lines broken or without a label."""
    n = table(s, d, "nation").orderBy("n_nationkey").coalesce(1)
    good = F.to_json(F.struct(F.concat(F.lit("N:"), F.col("n_nationkey").cast("string")).alias("iri"), F.col("n_name").alias("label"), F.array(F.lower("n_name")).alias("synonyms")))
    n.select(F.when(F.col("n_nationkey") % 5 == 0, F.lit('{"iri": "x", ')).when(F.col("n_nationkey") % 5 == 1, F.lit('{"iri": "x"}')).otherwise(good).alias("value")).write.text(path := _place(s, "lexicon"))
    return tables.read_lexicon(s, path).select("seq", "iri", "label", F.array_join("synonyms", ",").alias("synonyms"), "definition")


def dictionary_file(s, d):
    r = table(s, d, "region").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("r_name", F.array(F.lower("r_name"), F.col("r_regionkey").cast("string")))))).alias("m"))  # one object of five keys
    r.select(F.to_json("m").alias("value")).coalesce(1).write.text(path := _place(s, "dictionary"))
    return tables.read_dictionary(s, path, many=True)


def ntriples_files(s, d):
    t = triples(s, d).where("subj not like 'P:%'")
    literal = F.concat(F.lit('"'), F.replace("obj", F.lit('"'), F.lit('\\"')), F.lit('"'), F.coalesce(F.concat(F.lit("@"), "lang"), F.lit("")))
    line = F.concat(F.lit("<"), "subj", F.lit("> <"), "pred", F.lit("> "), F.when(F.col("literal"), literal).otherwise(F.concat(F.lit("<"), "obj", F.lit(">"))), F.lit(" ."))
    t.select(line.alias("value")).write.text(path := _place(s, "triples"))
    return tables.read_ntriples(s, path)


def rdf_xml_file(s, d):
    n = table(s, d, "nation")
    name = F.replace(F.replace("n_name", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    node = F.concat(F.lit('<owl:Class rdf:about="N:'), F.col("n_nationkey").cast("string"), F.lit('"><rdfs:label xml:lang="en">'), name, F.lit('</rdfs:label><obo:IAO_0000118>syn '), name, F.lit('</obo:IAO_0000118><obo:IAO_0000115>def '), F.col("n_regionkey").cast("string"), F.lit('</obo:IAO_0000115><rdfs:subClassOf rdf:resource="R:'), F.col("n_regionkey").cast("string"), F.lit('"/></owl:Class>'))
    whole = F.concat(F.lit('<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s" xmlns:obo="b">'), F.array_join(F.array_sort(F.collect_list(node)), ""), F.lit("</rdf:RDF>"))  # nations are a small table
    n.agg(whole.alias("value")).write.text(path := _place(s, "classes"))
    return tables.read_rdf_xml(s, path)


def vector_index_files(s, d):
    e = table(s, d, "embeddings").select(F.concat(F.lit("V:"), F.col("vec_id").cast("string")).alias("iri"), F.lit("a vector").alias("label"), "embedding")
    tables.write_vector_index(e, path := _place(s, "vectors"), "driver")
    facts = tables.read_vector_facts(s, path)
    return tables.read_vector_index(s, path, "driver").agg(F.count("*").alias("n"), F.countDistinct("iri").alias("iris")).crossJoin(F.broadcast(facts)).select("n", "iris", "dim", "count", "model")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        line_source, n0_spacing, n0_pairs, n0_numbers, n0_units, n0_dates, n0_times, n0_nfc, t1_tokens, t1_kind_counts, t1_pairs_view, marked_view, validate_ops, apply_ops, term_cleanup, hint_join,
        lexicon_build, nodes_full, edges, embed_text, gazetteer_surfaces, gaz_dedupe, resolve_alias, gaz_exact, gaz_phonetic, gaz_fuzzy, gaz_chunks, gaz_ngram, gazetteer_hits, placeholder_suppress, span_filter,
        surface_hints, freq_prior, coverage_stats, vec_topk, vec_rerank, vec_context, vec_hist, vec_encode, hybrid_attach, hybrid_fresh, hybrid_score, hybrid_rank, select_top1, bundles, rescue_gate, rescue_terms,
        line_stats, lexicon_gap, grid_search, nested_items, linked_mentions, linked_lexical, gaz_window_fuzzy, gaz_priors, gaz_build, hebrew_text, fdi_rule, op_survivors, hint_prompt, text_merged, vec_query_terms,
        force_vectors, best_point, run_summary, label_sample, jsonl_files, lexicon_file, dictionary_file, ntriples_files, rdf_xml_file, vector_index_files,
    )
}
