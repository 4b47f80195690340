"""Matching, ranking, review, assistants, sources and streams on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from lineweave.operators import assist, lexicon, match, rank, report, review, vector
from lineweave.operators.normalize import normalize
from lineweave.operators.tokenize import tokens, with_tokens
from lineweave.plans import linking, text_stage
from lineweave.sources import durable, tables
from lineweave.streaming import notes

KEYS = ["k"]
LEXICON = [(0, "http://purl.obolibrary.org/obo/OHD_1", "dental implant", ["fixture"], ""), (1, "http://purl.obolibrary.org/obo/FMA_2", "abutment", [], "a part"), (2, "X:3", "zirconia crown", [], ""), (3, "X:4", "12", ["twelve"], "")]


@pytest.fixture(scope="module")
def entries(spark):
    return spark.createDataFrame(LEXICON, "seq long, iri string, label string, synonyms array<string>, definition string").cache()


@pytest.fixture(scope="module")
def surfaces(spark, entries):
    variants = spark.createDataFrame([(i, s, e) for i, (s, _, e) in enumerate(lexicon.VARIANTS)], "seq long, alias string, en string")
    resolved = lexicon.resolve(variants.select(F.col("en").alias("alias")), entries)
    extra = variants.join(resolved.withColumnRenamed("alias", "en"), "en", "left").select((F.col("seq") + 10**9).alias("seq"), F.lower("alias").alias("surface"), F.coalesce("iri", F.lit("DEVICE:multiunit_abutment")).alias("iri"), F.col("alias").alias("label"), F.lit("label").alias("match_type"), F.lit(1.0).alias("score_lex"), F.coalesce("iri_source", F.lit("placeholder")).alias("iri_source"))
    return lexicon.dedupe_surfaces(lexicon.lexicon_surfaces(entries).unionByName(extra)).cache()


def toks(spark, texts):
    return tokens(normalize(spark.createDataFrame(list(enumerate(texts)), "k long, raw_text string")), KEYS)


def test_resolver_cascade(spark, entries):
    a = spark.createDataFrame([("Dental Implant",), ("fixture",), ("implant",), ("nothing at all",)], "alias string")
    got = {r["alias"]: (r["iri"], r["iri_source"]) for r in lexicon.resolve(a, entries).collect()}
    assert got == {"Dental Implant": (LEXICON[0][1], "ohd_label"), "fixture": (LEXICON[0][1], "ohd_synonym"), "implant": (LEXICON[0][1], "resolved_alias")}


def test_surfaces_skip_numbers_with_their_synonyms(surfaces):
    assert not {"12", "twelve"} & {r["surface"] for r in surfaces.collect()}


def test_gazetteer(spark, surfaces):
    texts = ["שתל 14", "שלת", "a new dental implant 18/0", "abutmant", "abtment", "zirconia crown fine fine fine abutment", "nothing"]
    got = match.gazetteer(toks(spark, texts), surfaces, KEYS).collect()
    by = {}
    for r in got:
        by.setdefault(r["k"], []).append(r)
    assert by[0][0]["label"] == "שתל" and by[0][0]["match_type"] == "label"
    assert by[1][0]["match_type"] == "fuzzy" and by[1][0]["score_lex"] == 0.82
    assert [(r["label"], r["s"], r["e"]) for r in by[2]] == [("dental implant", 0, 20)]
    assert by[4][0]["match_type"] == "phonetic" and by[4][0]["score_lex"] == match.PHONETIC
    assert {r["label"] for r in by[5]} == {"zirconia crown", "abutment"} and 6 not in by
    assert by[2][0]["hints"] == ["device_hint"]
    r = match.coverage(toks(spark, texts), match.gazetteer(toks(spark, texts), surfaces, KEYS)).first()
    assert r["mentions"] == len(got) and 0 < r["coverage_ratio"] <= 1


def test_no_vector_leaves_lexical_scores(spark, surfaces):
    out = linking.link(toks(spark, ["dental implant", "mu"]), surfaces, None, KEYS).collect()
    for r in out:
        assert r["score_final"] == pytest.approx(r["score_lex"] - (rank.PENALTY if r["iri_source"] == "placeholder" else 0))
    assert any(r["confident"] for r in out)


def test_link_with_vectors(spark, entries, surfaces):
    index = vector.encode(lexicon.embedding_text(entries), "text", vector.stub_encoder(), normalize=True)
    out = linking.link(toks(spark, ["implant of zirconia", "dental implant"]), surfaces, index, KEYS).collect()
    assert len({(r["k"], r["mention_id"]) for r in out}) == len(out) > 1


def test_a_block_of_queries_holds_a_strip_of_its_pairs():
    """Scores of all pairs of two blocks are 80 MB here; a strip of them and the vectors are a tenth of that."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(7)
    x, y = (rng.normal(size=(n, 8)).astype(np.float32) for n in (20_000, 500))
    table = lambda v: pa.table({"id": pa.array(range(len(v))), "v": pa.array(list(v), pa.list_(pa.float32()))})
    a, b = table(x), table(y)
    vector.best_of_block(a.slice(0, 9), b, 3)  # modules are loaded
    tracemalloc.start()
    got = vector.best_of_block(a, b, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    x, y = x.astype(float), y.astype(float)
    whole = (x @ y.T) / (np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :])
    assert np.allclose(got["score_cos"].to_numpy(), whole[got["qid"].to_numpy(), got["iri"].to_numpy()], rtol=0, atol=1e-11)


def test_top_k_equals_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).astype("f4")
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "iri long, embedding array<float>")
    old, vector.INDEX_BLOCK = vector.INDEX_BLOCK, 64  # several blocks
    got = vector.top_k(df.where("iri < 20").select(F.col("iri").alias("qid"), F.col("embedding").alias("q")), df, 5).collect()
    vector.INDEX_BLOCK = old
    s = x[:20].astype(float) @ x.T.astype(float)
    assert {(r["qid"], r["rank"]): r["iri"] for r in got} == {(q, k + 1): int(i) for q in range(20) for k, i in enumerate(np.argsort(-s[q], kind="stable")[:5])}


def lines_with_ops(spark, ops):
    n0 = normalize(spark.createDataFrame([(i, "word 14 18/0 end") for i in range(len(ops))], "k long, raw_text string"))
    both = with_tokens(n0)
    return both.join(spark.createDataFrame(list(enumerate(ops)), f"k long, ops {review.OPS}"), "k")


def test_review(spark):
    ops = [[("insert_space", 2, None, None)], [("merge_tokens", None, 1, 2)], [("insert_space", 99, None, None)], [("merge_tokens", None, 2, 1)], [], [("erase", None, None, None)], [("insert_space", 0, None, None)], [("merge_tokens", None, 0, 0)]]
    checked = review.validate(lines_with_ops(spark, ops))
    got = {r["k"]: (r["valid"], r["errors"]) for r in checked.collect()}
    assert [got[i][0] for i in range(len(ops))] == [False, False, False, False, True, False, True, True]
    assert "pair_insert:2" in got[0][1] and "merge_order:2-1" in got[3][1] and got[5][1] == ["op:erase"]
    merge = [[("merge_tokens", None, 0, 3)], [("insert_space", 3, None, None)]]
    edited = {r["k"]: r for r in review.digit_check(review.apply_ops(lines_with_ops(spark, merge)), "normalized_text", "edited").collect()}
    assert edited[0]["edited"] == "word1418/0end" and edited[1]["edited"] == "word 14 18/0 end " and not edited[0]["digit_mismatch"]
    view = review.marked_view(lines_with_ops(spark, [[]])).first()["view"]
    assert "[2] 18/0 (pair, span=[8, 12], script=digit) [A=18, B=0, sep=/]" in view and "<NUMBERS>" in view


def test_terms(spark):
    df = spark.createDataFrame([(["Implant", "implant", " ", "4 mm", "x-ray film"],)], "t array<string>")
    assert df.select(review.clean_terms(F.col("t"))).first()[0] == ["Implant", "x-ray film"]
    assert df.select(review.guard_terms(F.array(F.lit("a  b"), F.lit("-x"), F.lit("4"), F.lit("c"), F.lit("d"), F.lit("e")))).first()[0] == ["a b", "c", "d"]


def test_orchestrate_and_rescue(spark):
    lines = spark.createDataFrame([(0, "word 14"), (1, "bad 3/4")], "k long, raw_text string")
    said = lambda p: json.dumps({"ops": [{"op": "insert_space", "after_idx": 1 if "bad" in p else 0}], "canonical_terms": ["Implant", "implant"], "tooth_groups": [], "intent_hints": [], "ambiguous": False})
    got = {r["k"]: r for r in text_stage.orchestrate(lines, KEYS, said).collect()}
    assert got[0]["valid"] and got[0]["answer"]["canonical_terms"] == ["Implant"] and not got[1]["valid"] and got[1]["edited"] == "bad 3/4"
    r = assist.rescue(spark.createDataFrame([(0, "new IMPLANT"), (1, "none")], "k long, raw_text string")).collect()
    assert [(x["k"], x["canonical_terms"]) for x in r] == [(0, ["dental implant"])]


def test_sources(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"iri": "a", "label": "b"}\n\nnot json\n{"iri": "c"}\n', "utf-8")
    assert [(r["seq"], r["iri"], r["synonyms"]) for r in tables.read_lexicon(spark, str(tmp_path / "l.jsonl")).collect()] == [(0, "a", [])]
    (tmp_path / "t.nt").write_text('<s> <label> "a \\"b\\""@en .\n<s> <type> <o> .\n_:x <p> <o> .\n', "utf-8")
    assert sorted(tuple(r) for r in tables.read_ntriples(spark, str(tmp_path / "t.nt")).collect()) == [("s", "label", 'a "b"', "en", True), ("s", "type", "o", None, False)]
    (tmp_path / "x.txt").write_text(" a \n\n b14\n", "utf-8")
    assert [(r["line_no"], r["raw_text"]) for r in tables.read_lines(spark, str(tmp_path / "x.txt")).orderBy("line_no").collect()] == [(0, "a"), (2, "b14")]
    (tmp_path / "d.json").write_text('{"k": ["a", "b"]}', "utf-8")
    assert [tuple(r) for r in tables.read_dictionary(spark, str(tmp_path / "d.json"), many=True).collect()] == [("k", 0, "a"), ("k", 1, "b")]
    (tmp_path / "s.ndjson").write_text('{"patient_id": "p", "procedure_id": "q", "summary": {"status": "x", "items": [{"tooth": "1", "surfaces": ["M"]}, {"tooth": "2"}]}}\n{"patient_id": "r", "summary": {}}\n', "utf-8")
    assert tables.summary_items(tables.read_summaries(spark, str(tmp_path / "s.ndjson"))).count() == 3
    (tmp_path / "o.xml").write_text('<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s"><owl:Class rdf:about="i"><rdfs:label xml:lang="en">L</rdfs:label></owl:Class></rdf:RDF>', "utf-8")
    assert [tuple(r)[:4] for r in tables.read_rdf_xml(spark, str(tmp_path / "o.xml")).collect()] == [("i", "rdfs:label", "L", "en"), ("i", "rdf:type", "owl:Class", None)]
    body = '<owl:Class rdf:about="i"><rdf:type rdf:resource="t"/><rdfs:label>a</rdfs:label><rdfs:label xml:lang="de">b</rdfs:label><obo:IAO_0000118>s</obo:IAO_0000118><obo:IAO_0000115>d</obo:IAO_0000115><rdfs:subClassOf rdf:resource="p"/></owl:Class><owl:Class><rdfs:label>no name</rdfs:label></owl:Class>'
    (tmp_path / "p.xml").write_text(f'<rdf:RDF xmlns:rdf="r" xmlns:owl="o" xmlns:rdfs="s" xmlns:obo="b">{body}</rdf:RDF>', "utf-8")
    got = {tuple(r) for r in tables.read_rdf_xml(spark, str(tmp_path / "p.xml")).collect()}
    assert got == {("i", "rdfs:label", "a", None, True), ("i", "rdfs:label", "b", "de", True), ("i", "obo:IAO_0000118", "s", None, True), ("i", "obo:IAO_0000115", "d", None, True), ("i", "rdfs:subClassOf", "p", None, False), ("i", "rdf:type", "t", None, False), ("i", "rdf:type", "owl:Class", None, False)}


def test_vector_index_says_what_it_holds(spark, tmp_path):
    rows = spark.createDataFrame([("a", "A", [1.0, 0.0]), ("b", "B", [0.0, 1.0])], "iri string, label string, embedding array<float>")
    tables.write_vector_index(rows, str(tmp_path / "x"), "m")
    assert tuple(tables.read_vector_facts(spark, str(tmp_path / "x")).first()) == (2, 2, "m")
    assert {r["iri"] for r in tables.read_vector_index(spark, str(tmp_path / "x"), "m").collect()} == {"a", "b"}
    with pytest.raises(ValueError, match="made by"):
        tables.read_vector_index(spark, str(tmp_path / "x"), "other")
    rows.limit(1).write.mode("append").parquet(str(tmp_path / "x" / "rows"))
    with pytest.raises(ValueError, match="3 rows"):
        tables.read_vector_index(spark, str(tmp_path / "x"))


def test_numbered(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, "x") for i in range(1000)], "k long, t string").repartition(7)
    got = durable.numbered(df, "k").collect()
    assert sorted((r["k"], r["seq"]) for r in got) == [(i, i) for i in range(1000)]
    assert durable.numbered(df.where("false"), "k").count() == 0


def test_containment_equals_all_pairs(spark):
    names = ["ab", "abc", "b", "dental implant", "implant", "xabcx", "lant den", "a"]
    entries = spark.createDataFrame([(i, f"I:{i}", n, [n[::-1]] if i % 2 else []) for i, n in enumerate(names)], "seq long, iri string, label string, synonyms array<string>")
    aliases = ["the dental implant", "c", "bcx", "tal", "q", "", "  ", "ABCD", "z ab z", "implant of b"]
    got = {r["alias"]: (r["iri"], r["stage"]) for r in lexicon.resolve(spark.createDataFrame([(a,) for a in aliases], "alias string"), entries).collect()}
    for a in aliases:
        key = a.strip(" ").lower()
        hits = [(len(n), i) for i, n in enumerate(names) for m in ([n, n[::-1]] if i % 2 else [n]) if key and key not in names and (key in m or m in key)]
        assert got.get(a) == ((f"I:{min(hits)[1]}", 3) if hits else None), a


def test_resolver_falls_back_to_vectors(spark, entries):
    index = vector.encode(lexicon.embedding_text(entries), "text", vector.stub_encoder(), normalize=True)
    a = spark.createDataFrame([("abutnemt",), ("Dental Implant",), ("zirkonia krown",)], "alias string")
    got = {r["alias"]: (r["iri"], r["stage"]) for r in lexicon.resolve(a, entries, index, vector.stub_encoder()).collect()}
    assert got == {"abutnemt": (LEXICON[1][1], 4), "Dental Implant": (LEXICON[0][1], 1), "zirkonia krown": (LEXICON[2][1], 4)}


def test_queries_take_terms_then_translations(spark):
    t = toks(spark, ["kappa beta gamma delta", "kappa beta"])
    terms = spark.createDataFrame([(1, ["one", "two", "three", "four"])], "k long, canonical_terms array<string>")
    he2en = spark.createDataFrame([(1, "kappa", "second"), (0, "kappa", "first")], "seq long, key string, value string")
    got = {(r["k"], r["idx"]): r["query"] for r in linking.queries(t, KEYS, terms, he2en).collect()}
    assert got[0, 0] == "first" and got[0, 1] == "beta kappa gamma" and got[1, 0] == got[1, 1] == "one two three"


def test_lines_without_hits_are_searched_again(spark, entries, surfaces):
    lines = spark.createDataFrame([(0, "14/3"), (1, "implant 5")], "k long, raw_text string")

    def search(q, k):
        return [[("X:9", "nine", 0.9)] for _ in q]

    t = tokens(normalize(lines), KEYS)
    out = linking.link(t, surfaces.where("false"), search, KEYS, lines=lines).collect()
    assert {(r["k"], r["iri"]) for r in out} == {(1, "X:9")}
    told = linking.rescued(lines, match.gazetteer(t, surfaces.where("false"), KEYS), lines.where("false"), KEYS).collect()
    assert [(r["k"], r["canonical_terms"]) for r in told] == [(1, ["dental implant"])]
    said = lambda p: json.dumps({"canonical_terms": ["Crown", "4 mm"], "ops": []})
    assert [r["canonical_terms"] for r in assist.rescue(lines, client=said).collect()] == [["Crown"], ["Crown"]]


def test_retrieval_without_rerank(spark):
    index = spark.createDataFrame([("far", "l", [10.0, 10.0]), ("near", "l", [1.0, 0.0])], "iri string, label string, embedding array<float>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "qid long, q array<float>")
    first = lambda **o: vector.nearest(q, index, 1, **o).first()["iri"]
    assert first(by_cosine=False) == "far" and vector.nearest(q, index, 2).where("rank = 1").first()["iri"] == "near"


def test_hints_of_a_client(spark):
    lines = review.hint_prompt(review.marked_view(with_tokens(normalize(spark.createDataFrame([(0, "crown 14"), (1, "word")], "k long, raw_text string")))))
    prompt = {r["k"]: r["hint_prompt"] for r in lines.collect()}
    assert "[0] crown (word)\n[1] 14 (number)" in prompt[0] and "<TEXT>" in prompt[0]
    said = lambda p: json.dumps({"token_hints": [{"idx": 0, "device_hint": "crown", "tooth_group": "g"}, {"idx": 9, "device_hint": "x"}, {"device_hint": "y"}]} if "crown" in p else {"token_hints": []})
    hints = assist.token_hints(lines, said, KEYS)
    groups = spark.createDataFrame([("g", "14")], "tooth_group string, fdi string")
    t = tokens(normalize(spark.createDataFrame([(0, "crown 14"), (1, "word")], "k long, raw_text string")), KEYS)
    got = {(r["k"], r["idx"]): (r["hint"], r["fdi"]) for r in review.attach_hints(t, hints, groups, KEYS).collect()}
    assert got == {(0, 0): ("crown", "14"), (0, 1): (None, None), (1, 0): (None, None)}


def test_chat_endpoints():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Server(BaseHTTPRequestHandler):
        def do_GET(self):
            self.answer(200, {"models": [{"name": "m"}]}) if self.path == "/api/tags" else self.answer(404, {})

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            if asked["model"] != "m":
                return self.answer(404, {"error": f"model {asked['model']} not found"})
            if self.path != "/v1/chat/completions":
                return self.answer(404, {"error": "no such path"})
            return self.answer(200, {"choices": [{"message": {"content": json.dumps({"ops": [], "intent_hints": [m["role"] for m in asked["messages"]]})}}]})

        def answer(self, status, body):
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    assert json.loads(assist.http_client(url, "m", system="s", tries=1)("p"))["intent_hints"] == ["system", "user"]
    assert "no model z" in json.loads(assist.http_client(url, "z")("p"))["intent_hints"][0]
    assert assist.server_models(url) == ["m"] and assist.detect_server(url)["/api/tags"] == 200
    server.shutdown()
    assert json.loads(assist.http_client("http://127.0.0.1:9", "m", tries=1, timeout=1)("p"))["ambiguous"] and assist.server_models("http://127.0.0.1:9", timeout=1) == []


def test_surfaces_of_all_dictionaries(spark, entries):
    pair = lambda *rows: spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq long, key string, value string")
    aliases = spark.createDataFrame([(0, "Abutment", "DEVICE:a"), (1, "qqq", "DEVICE:q"), (2, "rrr", "http://purl.obolibrary.org/obo/OHD_7")], "seq long, alias string, mapped string")
    got = {r["surface"]: (r["iri"], r["match_type"], r["score_lex"], r["iri_source"]) for r in lexicon.build_surfaces(entries, pair(("ABB", "abutment long")), pair(("Acme", "acme one")), aliases, pair(("כתר", "zirconia crown"), ("קקק", "yyy"))).collect()}
    assert got["abb"] == ("ABBR:ABB", "label", 1.0, "abbreviation") and got["acme"] == ("BRAND:Acme", "label", 1.0, "brand_label") and got["acme one"] == ("BRAND:Acme", "synonym", 0.9, "brand_synonym")
    assert got["שתל"] == (LEXICON[0][1], "label", 1.0, "ohd_label") and got["mu"] == (LEXICON[1][1], "label", 1.0, "resolved_alias")
    assert got["qqq"] == ("DEVICE:q", "alias", 0.7, "alias_only") and got["rrr"] == ("http://purl.obolibrary.org/obo/OHD_7", "alias", 0.7, "alias_only") and got["abutment"][1] == "label"
    assert got["yyy"] == ("HE2EN:קקק", "he_en_alias", 0.7, "placeholder") and got["zirconia crown"][3] == "ohd_label"


def test_what_only_vectors_can_name(spark):
    rows = [(0, "m1", "DEVICE:1", "resolved_alias"), (0, "m1", "X", "alias_only"), (0, "m2", "X:1", "ohd_label"), (0, "m2", "DEVICE:1", "placeholder")]
    got = rank.needs_vectors(spark.createDataFrame(rows, "k long, mention_id string, iri string, iri_source string"), KEYS).collect()
    assert {r["mention_id"]: r["force"] for r in got} == {"m1": True, "m2": False}


def test_grid_equals_brute_force_without_repeating_candidates(spark):
    import random

    rng = random.Random(1)
    rows = [(k, f"m{m}", f"S{(k + m) % 5}", f"I{i}", rng.choice([0.0, 0.5, 1.0]), rng.choice([0.0, 0.5, 1.0]), rng.choice([0.0, 0.5]), rng.choice([0, 7])) for k in range(40) for m in range(3) for i in rng.sample(range(6), 4)]
    cands = spark.createDataFrame(rows, "k long, mention_id string, surface string, iri string, score_lex double, norm_vec double, score_prior double, seq long")
    gold = spark.createDataFrame([(f"s{i}", f"I{i}", 0) for i in range(4)], "surface string, iri string, seq int")  # S4 has none
    points = [(i, 0.1 * (i % 5), 0.1 * (i % 4), 0.05 * (i % 3)) for i in range(64)]  # more than fit one number
    graded = rank.accuracy_grid(cands, gold, spark.createDataFrame(points, "nth int, w_lex double, w_vec double, w_prior double"), KEYS)
    best = lambda rs, p: min(rs, key=lambda r: (-round(p[1] * r[4] + p[2] * r[5] + p[3] * r[6], 9), r[7], r[3]))[3]
    mentions = {}
    for r in rows:
        if r[2] != "S4":
            mentions.setdefault(r[:3], []).append(r)
    want = {p[0]: sum(best(rs, p) == f"I{key[2][1]}" for key, rs in mentions.items()) for p in points}
    assert {r["nth"]: (round(r["accuracy"] * len(mentions)), r["n"]) for r in graded.collect()} == {n: (v, len(mentions)) for n, v in want.items()}
    plan = graded._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Cross" not in plan


def test_stream(spark, tmp_path):
    spark.createDataFrame([("2024-01-01 00:00:00", "שתל14"), ("2024-01-01 02:00:00", "a 1/2")], "ts string, raw_text string").selectExpr("cast(ts as timestamp) ts", "raw_text").write.parquet(str(tmp_path / "in"))
    s = notes.kind_counts(notes.normalized(notes.read(spark, str(tmp_path / "in"), "ts timestamp, raw_text string")), "ts")
    q = s.writeStream.outputMode("complete").format("memory").queryName("kinds").start()
    q.processAllAvailable()
    q.stop()
    assert {(r["kind"], r["n"]) for r in spark.table("kinds").collect()} == {("word", 1), ("number", 1), ("pair", 1)}


def test_reports_on_empty_tables(spark):
    n0 = normalize(spark.createDataFrame([], "k long, raw_text string"))
    assert tuple(report.line_stats(n0, tokens(n0, KEYS)).first()) == (0, 0, 0.0, 0, 0)
