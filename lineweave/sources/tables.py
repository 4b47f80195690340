"""Sources: text lines, JSON lines, triples, nested summaries, vector indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .durable import numbered

LEXICON = "iri string, label string, synonyms array<string>, definition string"
SUMMARY = (
    "patient_id string, procedure_id string, visit_id string, summary struct<status:string,teeth_count:int,created_by:string,treatment_short_code_name:string,"
    "procedure_code:string,provider:string,patient_card_note:string,performed_at:string,items:array<struct<tooth:string,surfaces:array<string>>>,sticky_note_texts:array<string>>"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_of(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, line_no, raw_text): a text's lines, stripped, without blank ones; line_no counts all lines from 0."""
    rows = texts.select(F.col(id_col).alias("doc_id"), F.posexplode(F.split(text_col, "\n")).alias("line_no", "raw"))
    return rows.select("doc_id", "line_no", F.regexp_replace("raw", r"^\s+|\s+$", "").alias("raw_text")).where("raw_text <> ''")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, line_no, raw_text) of text files; doc_id is the file, line_no the place in it."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return lines_of(whole, "file", "value")


def read_jsonl(spark: SparkSession, path: str, schema: str, tolerant: bool = True) -> DataFrame:
    """JSON lines by schema. Tolerant: bad lines are dropped; else they fail the query."""
    if not tolerant:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    kept = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    return kept.where("_corrupt_record is null").drop("_corrupt_record")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(seq, iri, label, synonyms, definition); entries without IRI or label are dropped, seq keeps the files' order."""
    rows = read_jsonl(spark, path, LEXICON).where("iri <> '' and label <> ''")
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_row"))  # rows of a block are read in order
    rows = numbered(rows, "_file", "_at", "_row")
    return rows.select("seq", "iri", "label", F.coalesce("synonyms", F.array().cast("array<string>")).alias("synonyms"), F.coalesce("definition", F.lit("")).alias("definition"))


def read_dictionary(spark: SparkSession, path: str, many: bool = False) -> DataFrame:
    """(key, value) rows of one JSON object; values may be lists."""
    kind = "map<string,array<string>>" if many else "map<string,string>"
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", kind)).alias("key", "value"))
    return rows.select("key", F.posexplode("value").alias("nth", "value")) if many else rows


def read_ntriples(spark: SparkSession, path: str) -> DataFrame:
    """(subj, pred, obj, lang, literal) of N-Triples files; blank subjects are left out."""
    line = F.col("value")
    pattern = r'^\s*<([^>]*)>\s*<([^>]*)>\s*(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9-]+)|\^\^<[^>]*>)?)\s*\.\s*$'
    part = lambda i: F.regexp_extract(line, pattern, i)
    literal = line.rlike(r'^\s*<[^>]*>\s*<[^>]*>\s*"')
    text = F.replace(F.replace(F.replace(part(4), F.lit(r"\""), F.lit('"')), F.lit(r"\n"), F.lit("\n")), F.lit("\\\\"), F.lit("\\"))
    rows = spark.read.text(path).where(line.rlike(pattern))
    return rows.select(part(1).alias("subj"), part(2).alias("pred"), F.when(literal, text).otherwise(part(3)).alias("obj"), F.when(part(5) != "", part(5)).alias("lang"), literal.alias("literal"))


#: Elements of a class in RDF/XML that hold text, and those that refer to a resource.
RDF_TEXTS = ("rdfs:label", "obo:IAO_0000118", "obo:IAO_0000115")
RDF_LINKS = ("rdf:type", "rdfs:subClassOf")


def read_rdf_xml(spark: SparkSession, path: str, row_tag: str = "owl:Class", texts: tuple[str, ...] = RDF_TEXTS, links: tuple[str, ...] = RDF_LINKS) -> DataFrame:
    """Triples (subj, pred, obj, lang, literal) of the classes in RDF/XML.

    Predicates are element names. `texts` hold literals (labels, synonyms, definitions), `links` name a resource by attribute; the class itself
    adds its type. Classes without an IRI are left out.
    """
    text = T.StructType([T.StructField("_VALUE", T.StringType()), T.StructField("_xml:lang", T.StringType())])
    link = T.StructType([T.StructField("_rdf:resource", T.StringType()), T.StructField("_VALUE", T.StringType())])
    fields = [T.StructField(t, T.ArrayType(text)) for t in texts] + [T.StructField(x, T.ArrayType(link)) for x in links]
    rows = spark.read.format("xml").option("rowTag", row_tag).schema(T.StructType([T.StructField("_rdf:about", T.StringType()), *fields])).load(path)
    triple = lambda pred, obj, lang, literal: F.struct(F.lit(pred).alias("pred"), obj.alias("obj"), lang.cast("string").alias("lang"), F.lit(literal).alias("literal"))
    none = F.lit(None)
    said = lambda pred: F.transform(F.col(f"`{pred}`"), lambda x: triple(pred, x["_VALUE"], x["_xml:lang"], True))
    linked = lambda pred: F.transform(F.col(f"`{pred}`"), lambda x: triple(pred, x["_rdf:resource"], none, False))
    parts = [*map(said, texts), *map(linked, links)]
    parts.append(F.array(triple("rdf:type", F.lit(row_tag), none, False)))
    empty = F.array().cast("array<struct<pred:string,obj:string,lang:string,literal:boolean>>")
    told = rows.select(F.col("`_rdf:about`").alias("subj"), F.explode(F.concat(*(F.coalesce(p, empty) for p in parts))).alias("t"))
    return told.select("subj", "t.*").where("subj <> '' and obj is not null")


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY).json(path)


def summary_items(summaries: DataFrame) -> DataFrame:
    """One row a treated item; summaries without items keep a row of nulls."""
    return summaries.select("patient_id", "procedure_id", "visit_id", F.posexplode_outer("summary.items").alias("item_no", "item")).select("patient_id", "procedure_id", "visit_id", "item_no", "item.tooth", F.col("item.surfaces").alias("surfaces"))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_vector_index(df: DataFrame, path: str, model: str = "") -> None:
    """(iri, label, embedding) rows, sorted by IRI in each file, so that look-ups prune; beside them one row of facts: dim, count, model."""
    df.select("iri", "label", "embedding").sortWithinPartitions("iri").write.mode("overwrite").parquet(f"{path}/rows")
    facts = df.sparkSession.read.parquet(f"{path}/rows").agg(F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim"), F.count("*").alias("count"), F.lit(model).alias("model"))
    facts.coalesce(1).write.mode("overwrite").json(f"{path}/facts")


def read_vector_facts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("dim int, count long, model string").json(f"{path}/facts")


def read_vector_index(spark: SparkSession, path: str, model: str | None = None) -> DataFrame:
    """Rows of an index; it must hold as many as its facts say, of the dimension they say, and (if named) be made by the model."""
    facts, rows = read_vector_facts(spark, path).first(), spark.read.parquet(f"{path}/rows")
    if model is not None and facts["model"] != model:
        raise ValueError(f"the index was made by {facts['model']!r}, not {model!r}")
    found = rows.agg(F.count("*").alias("n"), F.count_if(F.size("embedding") != facts["dim"]).alias("odd")).first()
    if found["n"] != facts["count"] or found["odd"]:
        raise ValueError(f"the index has {found['n']} rows, {found['odd']} of another dimension; its facts say {facts['count']} of {facts['dim']}")
    return rows
