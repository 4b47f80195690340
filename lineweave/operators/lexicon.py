"""Lexicon from triples, surfaces for matching, and the alias cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.durable import stored

#: Spellings that stand for a concept: surface, placeholder, English name.
VARIANTS = (
    ("שתל", "IMPLANT:שתל", "dental implant"),
    ("שלת", "IMPLANT:שתל", "dental implant"),
    ("מולטיוניט", "DEVICE:multiunit_abutment", "multi-unit abutment"),
    ("מולטי יוניט", "DEVICE:multiunit_abutment", "multi-unit abutment"),
    ("מולטי-יוניט", "DEVICE:multiunit_abutment", "multi-unit abutment"),
    ("MU", "DEVICE:multiunit_abutment", "multi-unit abutment"),
    ("MUA", "DEVICE:multiunit_abutment", "multi-unit abutment"),
)
#: Scores of labels, synonyms and unresolved names.
LABEL, SYNONYM, UNRESOLVED = 1.0, 0.9, 0.7
#: Fixed value: where IRIs of the vocabularies begin.
VOCABULARY = "http://purl.obolibrary.org/obo/"
SURFACE = "seq long, surface string, iri string, label string, match_type string, score_lex double, iri_source string"


def lexicon(triples: DataFrame, label: str = "label", synonym: str = "synonym", definition: str = "definition") -> DataFrame:
    """(iri, label, synonyms, definition) of each subject with a label: the least English label, else the least of the least language."""
    lang = F.coalesce("lang", F.lit("und"))
    labels = triples.where(F.col("pred") == label).groupBy(F.col("subj").alias("iri")).agg(F.min_by("obj", F.struct(lang != "en", lang, "obj")).alias("label"), F.collect_set("obj").alias("all"))
    more = triples.where(F.col("pred").isin(synonym, definition)).groupBy(F.col("subj").alias("iri")).agg(F.collect_set(F.when(F.col("pred") == synonym, F.col("obj"))).alias("alt"), F.min(F.when(F.col("pred") == definition, F.col("obj"))).alias("definition"))
    both = labels.join(more, "iri", "left")
    others = F.filter("all", lambda x: x != F.col("label"))
    empty = F.array().cast("array<string>")
    return both.select("iri", "label", F.array_sort(F.array_union(F.coalesce("alt", empty), others)).alias("synonyms"), F.coalesce("definition", F.lit("")).alias("definition"))


def nodes(triples: DataFrame, core: dict[str, str]) -> DataFrame:
    """(iri, types, label, labels by language, synonyms, definitions, annotations by predicate). core: type, label, synonym, definition."""
    lang = F.coalesce("lang", F.lit("und"))
    role = F.when((F.col("pred") == core["type"]) & ~F.col("literal"), "type").when(F.col("literal"), F.when(F.col("pred") == core["label"], "label").when(F.col("pred") == core["synonym"], "synonym").when(F.col("pred") == core["definition"], "definition").otherwise("annotation"))
    rows = triples.select(F.col("subj").alias("iri"), role.alias("role"), F.when(role == "label", lang).when(role == "annotation", F.col("pred")).otherwise("").alias("key"), "obj").where("role is not null").distinct()
    lists = rows.groupBy("iri", "role", "key").agg(F.array_sort(F.collect_set("obj")).alias("values"))
    of = lambda r: F.flatten(F.collect_list(F.when(F.col("role") == r, F.col("values"))))
    mapped = lambda r: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("role") == r, F.struct("key", "values")))))
    out = lists.groupBy("iri").agg(of("type").alias("types"), mapped("label").alias("labels"), of("synonym").alias("synonyms"), of("definition").alias("definitions"), mapped("annotation").alias("annotations"))
    first = F.coalesce(F.try_element_at("labels", F.lit("en")), F.try_element_at("labels", F.get(F.array_sort(F.map_keys("labels")), F.lit(0))))
    return out.withColumn("label", F.get(first, F.lit(0)))


def edges(triples: DataFrame, core: dict[str, str]) -> DataFrame:
    """Triples between resources, without types and core predicates."""
    return triples.where(~F.col("literal") & ~F.col("pred").isin(*core.values())).select("subj", "pred", "obj")


def embedding_text(entries: DataFrame) -> DataFrame:
    """Adds `text`: label, synonyms and definition in one string."""
    synonyms = F.when(F.size("synonyms") > 0, F.concat(F.lit(" || "), F.array_join("synonyms", " | "))).otherwise(F.lit(""))
    definition = F.when(F.coalesce("definition", F.lit("")) != "", F.concat(F.lit(" ## "), "definition")).otherwise(F.lit(""))
    return entries.withColumn("text", F.concat("label", synonyms, definition))


def lexicon_surfaces(entries: DataFrame) -> DataFrame:
    """Surfaces of entries (seq, iri, label, synonyms): labels of digits or of two characters at most are left out with their synonyms."""
    fine = entries.where(~F.col("label").rlike(r"^\d+$") & (F.length("label") > 2))
    labels = fine.select((F.col("seq") * 1000).alias("seq"), F.lower("label").alias("surface"), "iri", "label", F.lit("label").alias("match_type"), F.lit(LABEL).alias("score_lex"), F.lit("ohd_label").alias("iri_source"))
    synonyms = fine.select("seq", "iri", "label", F.posexplode("synonyms").alias("n", "s")).select((F.col("seq") * 1000 + 1 + F.col("n")).alias("seq"), F.lower("s").alias("surface"), "iri", "label", F.lit("synonym").alias("match_type"), F.lit(SYNONYM).alias("score_lex"), F.lit("ohd_synonym").alias("iri_source"))
    return labels.unionByName(synonyms)


def dictionary_surfaces(pairs: DataFrame, prefix: str, source: str, match_type: str = "label", score: float = LABEL, label_is_key: bool = False, start: int = 10**9) -> DataFrame:
    """Surfaces of (seq, key, value) rows, such as abbreviations (label is the value) or brands (surface is the value)."""
    surface, label = ("value", "key") if label_is_key else ("key", "value")
    return pairs.select((F.col("seq") + start).alias("seq"), F.lower(surface).alias("surface"), F.concat(F.lit(f"{prefix}:"), "key").alias("iri"), F.col(label).alias("label"), F.lit(match_type).alias("match_type"), F.lit(score).alias("score_lex"), F.lit(source).alias("iri_source"))


def alias_surfaces(aliases: DataFrame, resolved: DataFrame, match_type: str = "alias", start: int = 2 * 10**9, unresolved: str = "alias_only", score: float = SYNONYM, lost: float = UNRESOLVED) -> DataFrame:
    """Surfaces of (seq, alias, mapped) rows: resolved to a concept where the cascade finds one for the alias, else kept as placeholder.

    A column `surface`, if there is one, is what texts hold in place of the alias.
    """
    got = aliases.join(resolved.select(F.col("alias"), F.col("iri").alias("r"), F.col("iri_source").alias("src")), "alias", "left")
    known, surface = F.col("r").isNotNull(), F.col("surface" if "surface" in aliases.columns else "alias")
    return got.select((F.col("seq") + start).alias("seq"), F.lower(surface).alias("surface"), F.coalesce("r", "mapped").alias("iri"), surface.alias("label"), F.lit(match_type).alias("match_type"), F.when(known, F.lit(score)).otherwise(F.lit(lost)).alias("score_lex"), F.when(known, F.col("src")).otherwise(F.lit(unresolved)).alias("iri_source"))


def dedupe_surfaces(surfaces: DataFrame) -> DataFrame:
    """The best entry of each surface: label, synonym, vector, anything else, unresolved; then the first."""
    rank = F.when(F.col("iri_source").isin("alias_only", "placeholder"), 5).when(F.col("match_type") == "label", 1).when(F.col("match_type") == "synonym", 2).when(F.col("match_type") == "vector", 3).otherwise(4)
    w = Window.partitionBy("surface").orderBy(rank, "seq")
    return surfaces.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


#: Characters by which strings meet that may hold each other.
GRAM = 3


def _holding(short: DataFrame, long: DataFrame) -> DataFrame:
    """Rows (s, l) of distinct strings where l holds s: they meet on the first GRAM characters of s, or all of a shorter one."""
    key = short.select("s", F.substring("s", 1, GRAM).alias("g"))
    grams = lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length("l") - n + 1, F.lit(1))), lambda i: F.substring(F.col("l"), i, F.lit(n)))
    whole = long.select("l", F.explode(F.array_distinct(F.flatten(F.array(*(grams(n) for n in range(1, GRAM + 1)))))).alias("g"))
    return key.join(whole, "g").where(F.contains("l", "s")).select("s", "l").distinct()


def resolve(aliases: DataFrame, entries: DataFrame, index: DataFrame | None = None, encoder=None) -> DataFrame:
    """(alias, iri, label, iri_source, stage): equal label, equal synonym, containment either way with the shortest label, nearest vectors.

    Each stage takes only the aliases that the ones before it leave. Containment is an equi-join on short runs of characters that is
    verified. With an index (iri, embedding) and an encoder, the fourth stage takes of the three nearest concepts the one whose label or one of
    whose first three synonyms is the fewest edits away; without them it is left out.
    """
    a = aliases.select("alias").distinct().withColumn("key", F.lower(F.trim("alias")))
    names = entries.select("seq", "iri", "label", F.lower("label").alias("name"), F.lit(1).alias("stage")).unionByName(entries.select("seq", "iri", "label", F.explode("synonyms").alias("name")).withColumn("name", F.lower("name")).withColumn("stage", F.lit(2)))
    exact = a.join(names, F.col("key") == F.col("name"))
    first = Window.partitionBy("alias").orderBy("stage", "seq")
    exact = exact.withColumn("_n", F.row_number().over(first)).where("_n = 1").select("alias", "iri", "label", F.when(F.col("stage") == 1, "ohd_label").otherwise("ohd_synonym").alias("iri_source"), "stage")
    rest = a.join(exact.select("alias"), "alias", "left_anti").where("key <> ''")
    keys, known = rest.select("key").distinct(), names.where("name <> ''").select("name").distinct()
    within = _holding(keys.select(F.col("key").alias("s")), known.select(F.col("name").alias("l"))).select(F.col("s").alias("key"), F.col("l").alias("name"))
    around = _holding(known.select(F.col("name").alias("s")), keys.select(F.col("key").alias("l"))).select(F.col("l").alias("key"), F.col("s").alias("name"))
    inside = rest.join(within.unionByName(around).distinct(), "key").join(names, "name")
    short = Window.partitionBy("alias").orderBy(F.length("label"), "seq")
    inside = inside.withColumn("_n", F.row_number().over(short)).where("_n = 1").select("alias", "iri", "label", F.lit("resolved_alias").alias("iri_source"), F.lit(3).alias("stage"))
    found = exact.unionByName(inside)
    if index is None or encoder is None:
        return found
    from . import vector

    left = stored(rest.join(inside.select("alias"), "alias", "left_anti").select("alias", "key"), "unresolved")
    asked = vector.encode(left.select("key").distinct(), "key", encoder, "q")
    top = vector.top_k(asked, index, 3, qid="key").select(F.col("qid").alias("key"), "iri", "rank")
    edits = F.array_min(F.transform(F.concat(F.array("label"), F.slice("synonyms", 1, 3)), lambda s: F.levenshtein("key", F.lower(s))))
    best = left.join(top, "key").join(entries.select("iri", "label", "synonyms"), "iri").groupBy("alias").agg(F.min_by(F.struct("iri", "label"), F.struct(edits, "rank")).alias("b"))
    return found.unionByName(best.select("alias", "b.iri", "b.label", F.lit("resolved_alias").alias("iri_source"), F.lit(4).alias("stage")))


def variant_rows(spark) -> DataFrame:
    """(seq, alias, placeholder, en) of VARIANTS."""
    return spark.createDataFrame([(i, *v) for i, v in enumerate(VARIANTS)], "seq long, alias string, placeholder string, en string")


def build_surfaces(entries: DataFrame, abbreviations: DataFrame | None = None, brands: DataFrame | None = None, aliases: DataFrame | None = None, he2en: DataFrame | None = None, variants: DataFrame | None = None, index: DataFrame | None = None, encoder=None) -> DataFrame:
    """All surfaces of a matching run, the best entry of each: labels and synonyms, abbreviations and brands, spelling variants, aliases, translations.

    abbreviations, brands, he2en: (seq, key, value), a row a value; variants: (seq, alias, placeholder, en); aliases: (seq, alias, mapped IRI). Variants
    are resolved by their English name and count as labels either way; aliases by themselves, unless they are mapped to a vocabulary's concept;
    of translations the English form is the surface, and its placeholder names the key.
    """
    spark = entries.sparkSession
    rows = lambda df, kind: df if df is not None else spark.createDataFrame([], kind)
    pair = "seq long, key string, value string"
    abbreviations, brands, he2en = rows(abbreviations, pair), rows(brands, pair), rows(he2en, pair)
    variants, aliases = variants if variants is not None else variant_rows(spark), rows(aliases, "seq long, alias string, mapped string")
    open_ = aliases.where(~F.startswith("mapped", F.lit(VOCABULARY)))
    asked = variants.select(F.col("en").alias("alias")).union(open_.select("alias")).union(he2en.select(F.col("value").alias("alias")))
    known = stored(resolve(asked, entries, index, encoder), "resolved")
    none = known.where("false")
    named = brands.groupBy("key").agg(F.min("seq").alias("seq"))
    parts = [
        lexicon_surfaces(entries),
        dictionary_surfaces(abbreviations, "ABBR", "abbreviation"),
        dictionary_surfaces(named.withColumn("value", F.col("key")), "BRAND", "brand_label", start=2 * 10**9),
        dictionary_surfaces(brands, "BRAND", "brand_synonym", "synonym", SYNONYM, label_is_key=True, start=2 * 10**9 + 1),
        alias_surfaces(variants.select("seq", F.col("en").alias("alias"), F.col("placeholder").alias("mapped"), F.col("alias").alias("surface")), known, "label", 3 * 10**9, "placeholder", LABEL, LABEL),
        alias_surfaces(open_, known, "alias", 4 * 10**9),
        alias_surfaces(aliases.where(F.startswith("mapped", F.lit(VOCABULARY))), none, "alias", 4 * 10**9),
        alias_surfaces(he2en.select("seq", F.col("value").alias("alias"), F.concat(F.lit("HE2EN:"), "key").alias("mapped")), known, "he_en_alias", 5 * 10**9, "placeholder"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return dedupe_surfaces(out)
