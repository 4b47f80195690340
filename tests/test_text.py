"""Normalization and tokens: fixed cases and invariants."""

import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from lineweave.functions import text as X
from lineweave.operators.normalize import normalize
from lineweave.operators.tokenize import token_arrays, tokens, with_tokens

CASES = ["", None, "מולטיוניט שתל14 18/0", "14שתל", "14-16", "13\\15", "מרווח 2ממ", "שיניים 25 27 31 32", "100%", "30° x", "1.5/3", "18/0 18/0", "12/03/24 10:30", "multi-unit 4.3mm", "café"]


def rows(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, raw_text string")
    n0 = normalize(df)
    got = {r["k"]: r for r in with_tokens(n0).collect()}
    for r in token_arrays(tokens(n0, ["k"]), ["k"]).collect():  # as rows, too
        assert r["tokens"] == got[r["k"]]["tokens"]
    return got


def test_cases(spark):
    got = rows(spark, CASES)
    of = lambda t: got[CASES.index(t)]
    assert of("")["normalized_text"] == "" and of(None)["tokens"] == []
    r = of("מולטיוניט שתל14 18/0")
    assert r["normalized_text"] == "מולטיוניט שתל 14 18/0" and r["numbers"] == ["14", "18", "0"] and r["notes"] == ["inserted_space_hebrew_digit"]
    assert [tuple(p) for p in r["pairs"]] == [("18/0", "18", "0", "/", 17, 21)]
    assert [(t["kind"], t["s"], t["e"]) for t in r["tokens"]] == [("word", 0, 9), ("word", 10, 13), ("number", 14, 16), ("pair", 17, 21)]
    assert of("14שתל")["normalized_text"] == "14 שתל"
    assert of("מרווח 2ממ")["normalized_text"] == "מרווח 2 mm" and of("מרווח 2ממ")["units_found"] == ["mm"]
    assert [t["text"] for t in of("100%")["tokens"]] == ["100", "%"]
    assert [t["text"] for t in of("1.5/3")["tokens"]] == ["1.5", "/", "3"]
    assert len(of("18/0 18/0")["pairs"]) == 2 and of("13\\15")["pairs"][0]["sep"] == "\\"
    assert of("12/03/24 10:30")["dates"] == ["12/03/24", "12/03/24"] and of("12/03/24 10:30")["times"] == ["10:30"]
    assert [t["kind"] for t in of("multi-unit 4.3mm")["tokens"]] == ["word", "number", "unit"]
    assert of("café")["normalized_text"] == "café"


def test_invariants(spark):
    alphabet = st.sampled_from("שתלםabcm 0123/-\\.%°,()\"'מ")
    texts = []

    @settings(max_examples=150, database=None, derandomize=True)
    @given(st.text(alphabet, max_size=24))
    def collect(t):
        texts.append(t)

    collect()
    for r in rows(spark, texts).values():
        text, toks = r["normalized_text"], r["tokens"] or []
        assert [t["idx"] for t in toks] == list(range(len(toks)))
        assert all(text[t["s"] : t["e"]] == t["text"] for t in toks)
        assert sorted(re.sub(r"\s", "", text)) == sorted(re.sub(r"\s", "", "".join(t["text"] for t in toks)))
        assert Counter(re.findall(r"\d", r["raw_text"])) == Counter(re.findall(r"\d", text))


def test_spans_of_a_long_line(spark):
    text = " ".join(f"w{i}" if i % 3 else f"{i}/7" for i in range(3000)) + " " * 300 + "end"
    r = with_tokens(spark.createDataFrame([(0, text)], "k long, normalized_text string")).first()["tokens"]
    assert [t["text"] for t in r if t["kind"] == "pair"] == [f"{i}/7" for i in range(0, 3000, 3)] and all(text[t["s"] : t["e"]] == t["text"] for t in r)


def test_pairs_with_loose_spacing(spark):
    cases = ["18 /0 18/0", "1/2/3 2/3", "118/0 18/0", "3 - 4 3-4", "5\\6 5 \\ 6"]
    got = rows(spark, cases)
    for i, t in enumerate(cases):
        for p in got[i]["pairs"]:
            m = re.search(rf"{p['a']}\s*{re.escape(p['sep'])}\s*{p['b']}", t)
            assert (p["text"], p["s"], p["e"]) == (m[0], m.start(), m.end())


def damerau(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_one_edit_and_its_blocking(spark):
    words = ["", "a", "ab", "ba", "abc", "acb", "שתל", "שלת", "שתלי", "לתש", "abcd", "abdc", "xbcd"]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    from pyspark.sql import functions as F

    got = df.select("a", "b", X.within_one_edit(F.col("a"), F.col("b")).alias("near"), F.arrays_overlap(X.deletions(F.col("a")), X.deletions(F.col("b"))).alias("meet")).collect()
    for r in got:
        assert r["near"] == (damerau(r["a"], r["b"]) <= 1), r
        assert r["meet"] or not r["near"], r


def test_small_functions(spark):
    from pyspark.sql import functions as F

    r = spark.range(1).select(X.phonetic(F.lit("Abutment")).alias("p"), X.normalize_hebrew(F.lit(" שלום  ‏ABC ")).alias("n"), X.is_mostly_hebrew(F.lit("שתל a")).alias("h"), X.strip_joiners(F.lit("a-b c")).alias("j")).first()
    assert tuple(r) == ("abtmnt", "שלומ abc", True, "abc")
