"""Line dedup: exact set-similarity join over the lines of all documents. DataFrame functions only.

A line's tokens are its distinct words, the rarest first: a word's rarity is the logarithm of how often it occurs in all documents,
counted in a table of fixed size, and ties go by hash, so the order is the same everywhere. Lines that share a token in their prefixes
are compared by length (lines of unlike sizes do not meet), by the places of that token, and by a signature: a bit for each token hash, flipped by every token that has
it, so that unlike bits are no more than unlike tokens. What passes is verified on all tokens. A line is removed if an earlier line (by
document, then place) equals it or has a Jaccard similarity of 0.75 or more with it, whether or not that one is removed itself.

Copies are one line from the start; their hashes are combined before any shuffle. Large groups of similar lines first meet the earliest lines of the most
frequent tokens in their prefixes; only a line left unmatched by those has to meet all others, so such groups make no square of pairs.
Each pair is met from its longer line, whose prefix is a quarter of it; of the shorter one a seventh is enough.

Cases: null texts stay null; lines without words are never removed or compared; rows that repeat an id, and null ids, are documents of
their own one after the other (null first, then by id and hash of the text); a document may lose all its lines and is then empty; other
columns pass through, and names of added columns that clash raise an error; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import discard, free, publish, publish_hashes, table

#: Similarity as a fraction; entries of the table of word counts; set sizes beyond which a signature has two words of 64 bits, and four, instead of one.
NUM, DEN, WORD_TABLE, LONG_SET, VERY_LONG_SET = 3, 4, 1 << 17, 80, 180
#: Rounds in which lines are joined, first those of classes that one signature word is enough for, then longer ones; the tokens of either are dealt by
#: their hash to so many rounds, so that one round's share of the postings is on disk at a time.
DEALT = 2
ROUNDS = 2 * DEALT
#: Rows in which the table of word counts is made.
WORD_GROUPS = 1 << 16
#: Sizes of lines are told apart in classes, of which there are these many for every factor of e: a pair's sizes lie in one class or in two.
SIZE_CLASSES = 3.4
#: Tokens by which a line meets leaders, leaders of a token, postings from which a token has leaders; numbers up to which a side of a join is broadcast.
LEADING, LEADERS, LED_FROM, BROADCAST_ROWS = 1, 2, 32, 4_000_000
_TRIM, _SPLIT, _BLANKS = " \t\x0b\x0c\r", r"[\x20\x09-\x0D]+", ("\t", "\x0b", "\x0c", "\r")
ADDED = ("n_lines", "n_exact", "n_near")
_SIGNATURE = ("s0", "s1", "s2", "s3")


def _words(c: Column) -> Column:
    """Words of a text without line ends, and empty ones between spaces; a pattern is used only where it is needed."""
    odd = functools.reduce(Column.__or__, (F.contains(c, F.lit(blank)) for blank in _BLANKS))
    return F.when(odd, F.split(c, _SPLIT)).otherwise(F.split(c, " "))


def _trimmed(c: Column) -> Column:
    edge = F.startswith(c, F.lit(" ")) | F.endswith(c, F.lit(" "))
    for blank in _BLANKS:
        edge = edge | F.startswith(c, F.lit(blank)) | F.endswith(c, F.lit(blank))
    return F.when(edge, F.btrim(c, F.lit(_TRIM))).otherwise(c)


def line_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """(num, pos, line) of each line that has words; white space at the ends does not count."""
    rows = docs.select(F.col("_num").alias("num"), F.posexplode(F.split(text_col, "\n")).alias("pos", "line"))
    return rows.select("num", "pos", _trimmed(F.col("line")).alias("line")).where("line <> ''")


def word_classes(hashed: DataFrame) -> str:
    """SQL array, by hash of a word, of four times the binary logarithm of how many lines hold words with that hash.

    The counts order tokens, and any order that is the same everywhere is exact. Few groups with several counts each are counted faster than many groups.
    """
    halves = WORD_TABLE // WORD_GROUPS
    part = F.shiftright("x", WORD_GROUPS.bit_length() - 1).bitwiseAND(F.lit(halves - 1))
    words = hashed.select(F.explode("h").alias("x")).groupBy(F.col("x").bitwiseAND(F.lit(WORD_GROUPS - 1)).alias("b"))
    classes = [0] * WORD_TABLE
    for b, *counts in words.agg(*(F.count_if(part == k).alias(f"n{k}") for k in range(halves))).collect():  # WORD_GROUPS rows at most
        for k, n in enumerate(counts):
            classes[b + k * WORD_GROUPS] = min(127, int(4 * math.log2(n)) + 1) if n else 0
    return f"from_json('{classes}', 'array<bigint>')"


def _hashes(lines: DataFrame) -> DataFrame:
    """Adds `h`: the hashes of a line's distinct words."""
    return lines.withColumn("h", F.array_remove(F.array_distinct(F.transform(_words(F.col("line")), lambda x: F.xxhash64(x))), F.xxhash64(F.lit(""))))


def prefixes(hashed: DataFrame, classes: str) -> DataFrame:
    """(ord, n, signature, prefix) of lines with `h`: set size, signature, and the rarest tokens that a similar line must share one of."""
    bit = "shiftleft(1L, cast(x & 63 AS int))"
    fold = lambda test: f"aggregate(h, 0L, (a, x) -> {f'if({test}, a ^ {bit}, a)' if test else f'a ^ {bit}'})"
    told = hashed.withColumn("n", F.size("h"))
    two, four = fold("(x & 64) = 64"), [fold(f"(x & 192) = {64 * k}") for k in range(4)]
    told = told.selectExpr("ord", "n", "h", f"{fold('')} AS s", f"if(n > {VERY_LONG_SET}, {four[1]}, if(n > {LONG_SET}, {two}, 0L)) AS s1", *(f"if(n > {VERY_LONG_SET}, {four[k]}, 0L) AS s{k}" for k in (2, 3)))
    signature = ["s ^ s1 ^ s2 ^ s3 AS s0", "s1", "s2", "s3"]  # of all bits, the first word has what the others leave
    ranked = f"sort_array(transform(h, x -> coalesce(shiftleft({classes}[x & {WORD_TABLE - 1}], 56) | (x & {(1 << 56) - 1}), 0L)))"  # without nulls, longs are sorted as such
    return told.selectExpr("ord", "n", *signature, f"slice({ranked}, 1, n - cast(ceil({NUM} * n / {DEN}) AS int) + 1) AS prefix")


def _alike(x: dict, y: dict, signature: tuple | list = _SIGNATURE) -> str:
    """Length and signature filter of two lines: unlike tokens are at most a share of both sizes. The signature has four words, or one of all bits."""
    folded = lambda *names: " + ".join("bit_count(" + " ^ ".join(t[c] for t in (x, y) for c in part) + ")" for part in names)
    least = f"least({x['n']}, {y['n']})"  # the shorter one's words are sums of the longer one's
    unlike = folded(signature) if len(signature) == 1 else f"if({least} > {VERY_LONG_SET}, {folded(('s0',), ('s1',), ('s2',), ('s3',))}, if({least} > {LONG_SET}, {folded(('s0', 's2'), ('s1', 's3'))}, {folded(_SIGNATURE)}))"
    return f"{DEN} * {x['n']} >= {NUM} * {y['n']} AND {DEN} * {y['n']} >= {NUM} * {x['n']} AND {NUM + DEN} * {unlike} <= {DEN - NUM} * ({x['n']} + {y['n']})"


def _side(t: str, packed: bool) -> dict:
    """SQL of a line's fields in a join; postings pack size, place and openness into `m`."""
    own = {c: f"{t}.{c}" for c in ("ord", "n", *_SIGNATURE)}  # only what is asked for has to be there
    return own | {"n": f"shiftright({t}.m, 32)", "i": f"shiftright({t}.m & 4294967295L, 1)", "open": f"({t}.m & 1L) = 1"} if packed else own


def _leader_pairs(firsts: DataFrame) -> DataFrame:
    """(later, earlier) of lines and the earliest lines with one of their most frequent prefix tokens."""
    own = f"slice(prefix, greatest(size(prefix) - {LEADING - 1}, 1), {LEADING})"
    posts = firsts.select(F.explode(F.expr(own)).alias("token"), "ord", "n", *_SIGNATURE)
    lead = posts.groupBy("token", F.pmod(F.xxhash64("ord"), F.lit(LEADERS)).alias("salt")).agg(F.min("ord").alias("ord"), F.count("*").alias("rows")).where(F.col("rows") >= LED_FROM)
    lead = _small(publish(lead.select("token", "ord"), "line-lead"), F.lit(8))
    lead = _small(publish(firsts.select("ord", "n", *_SIGNATURE).join(lead, "ord"), "line-lead"), F.lit(8))
    x, y = _side("x", False), _side("y", False)
    met = posts.alias("x").join(lead.alias("y"), F.col("x.token") == F.col("y.token")).where(F.expr(f"y.ord < x.ord AND {_alike(x, y)}"))
    return met.select(F.col("x.ord").alias("later"), F.col("y.ord").alias("earlier")).distinct()


def _postings(firsts: DataFrame, nth: int) -> tuple[DataFrame, DataFrame]:
    """Lines by tokens of the nth round, as the longer line of a pair and as the shorter one.

    The key is a token and a class of sizes: the longer line's own, and for the shorter one each class of the sizes that a longer one may have, so
    that lines of unlike sizes do not meet. Rounds of short classes have the signature as one word, `s0`.
    """
    of = lambda n: f"cast(floor({SIZE_CLASSES} * ln({n})) AS bigint)"
    wide, deal = divmod(nth, DEALT)
    here = lambda c: f"{c} {'>' if wide else '<='} {int(SIZE_CLASSES * math.log(LONG_SET))}"
    signature = [*_SIGNATURE] if wide else ["s0 ^ s1 ^ s2 ^ s3 AS s0"]
    sized = firsts.selectExpr("ord", "n", "open", "prefix", *signature, f"{of('n')} AS own", f"{of(f'floor({DEN} * n / {NUM})')} AS top")  # once a line, not once a posting
    posts = lambda lines, prefix: lines.select(F.posexplode(prefix).alias("i", "token"), *(c for c in sized.columns if c != "prefix")).where(F.col("token") % DEALT == deal)
    key = lambda c: f"shiftleft(shiftright(token, 12) & 4294967295, 7) | {c}"  # noqa: E731  # 32 bits: equal tokens stay equal, unlike ones that meet are told apart later
    packed = "shiftleft(cast(n AS bigint), 32) | shiftleft(cast(i + 1 AS bigint), 1) | cast(open AS bigint) AS m"
    short = posts(sized.where(here("top" if wide else "own")), F.expr(f"slice(prefix, 1, n - cast(ceil({2 * NUM} * n / {NUM + DEN}) AS int) + 1)"))
    most = f"least(floor({DEN} * n / {NUM}), floor({NUM + DEN} * (n - i) / {NUM}) - n)"  # the largest size that may hold the overlap
    short = short.withColumn("c", F.explode(F.expr(f"if(top = own, array(own), sequence(own, {of(most)}))"))).where(here("c"))
    sides = [posts(sized.where(here("own")), F.col("prefix")).withColumn("token", F.expr(key("own"))), short.withColumn("token", F.expr(key("c")))]
    return tuple(x.selectExpr("token", "ord", packed, *(c for c in _SIGNATURE if c in sized.columns)) for x in sides)


def _other_pairs(firsts: DataFrame, nth: int) -> DataFrame:
    """(later, earlier) of all lines that may be similar by a token of the nth round, `open` ones being later; the longer line of a pair is x.

    Of the first token that two lines share, what follows it in either must hold their overlap.
    """
    long, short = _postings(firsts, nth)
    x, y = _side("x", True), _side("y", True)
    reaches = " AND ".join(f"{NUM + DEN} * ({t['n']} - {t['i']} + 1) >= {NUM} * ({x['n']} + {y['n']})" for t in (x, y))
    order = f"({y['n']} < {x['n']} OR {y['n']} = {x['n']} AND y.ord < x.ord) AND if(x.ord > y.ord, {x['open']}, {y['open']})"
    alike = _alike(x, y, [c for c in _SIGNATURE if c in long.columns])
    met = long.alias("x").join(short.alias("y"), F.col("x.token") == F.col("y.token")).where(F.expr(f"{order} AND {reaches} AND {alike}"))
    return met.select(F.expr("greatest(x.ord, y.ord) AS later"), F.expr("least(x.ord, y.ord) AS earlier")).distinct()


def _few(df: DataFrame, numbers: Column) -> bool:
    return (df.agg(F.sum(numbers)).first()[0] or 0) <= BROADCAST_ROWS


def _small(df: DataFrame, numbers: Column) -> DataFrame:
    """df, to be broadcast if it holds few numbers; beyond, a shuffle join gives the same."""
    return F.broadcast(df) if _few(df, numbers) else df


def _verified(found: list[DataFrame], docs: DataFrame, text_col: str, lines: int) -> DataFrame:
    """The later lines of pairs whose word sets are similar. Only documents with such lines are read, and of them only these lines."""
    pairs = publish(functools.reduce(DataFrame.unionByName, found).distinct(), "line-pairs") if len(found) > 1 else found[0]
    ords = pairs.select(F.explode(F.array("later", "earlier")).alias("ord")).distinct()
    asked = ords.groupBy(F.floor(F.col("ord") / F.lit(lines)).cast("long").alias("num")).agg(F.collect_list((F.col("ord") % lines).cast("int")).alias("places"))  # no more than a document has lines
    asked = _small(publish(asked, "line-asked"), F.size("places") + 4)
    picked = F.transform(F.array(F.split(text_col, "\n")), lambda all_: F.transform("places", lambda p: F.struct(p.alias("pos"), all_[p].alias("line"))))[0]  # splits a text once
    of = docs.join(asked, docs._num == asked.num).select("num", F.inline(picked))
    of = of.select(_ord(lines).alias("ord"), _trimmed(F.col("line")).alias("line"))
    sets = publish_hashes(_hashes(of).select("ord", "h"), "line-sets")
    x, y = sets.select(F.col("ord").alias("later"), F.col("h").alias("hx")), sets.select(F.col("ord").alias("earlier"), F.col("h").alias("hy"))

    def similar(some: DataFrame) -> DataFrame:
        both = some.join(x, "later").join(y, "earlier")  # the overlap stands in the filter once, or it would be computed twice
        return both.where(f"{NUM + DEN} * size(array_intersect(hx, hy)) >= {NUM} * (size(hx) + size(hy))").select(F.col("later").alias("ord")).distinct()

    # one earlier line is enough: each line first meets its earliest candidate, and only one that is not similar to that meets the others
    near = publish(similar(pairs.groupBy("later").agg(F.min("earlier").alias("earlier"))), "line-near")
    rest = pairs.join(_small(near.withColumnRenamed("ord", "later"), F.lit(1)), "later", "left_anti")
    near = publish(near.unionByName(similar(rest)), "line-near")
    for df in (*found, sets):
        discard(df)
    if len(found) > 1:
        discard(pairs)
    return near


def _ord(lines: int) -> Column:
    """Number of a line in the order of documents and places."""
    return F.col("num") * F.lit(lines) + F.col("pos")


def numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with `_num`, a number from 0 in the order of documents: the id, less the smallest; where ids repeat, are null or too far apart, the place in their order."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    s = ids.agg(F.count("*").alias("n"), F.count("id").alias("known"), F.min("id").alias("low"), F.max("id").alias("high")).first()
    if s["n"] == s["known"] and (s["n"] == 0 or s["high"] - s["low"] < 2**40) and ids.groupBy("id").count().where("count > 1").isEmpty():
        return docs.withColumn("_num", F.col(id_col).cast("long") - F.lit(s["low"] or 0))
    return publish(docs.orderBy(F.col(id_col).asc_nulls_first(), F.xxhash64(text_col)).withColumn("_num", F.monotonically_increasing_id()), "line-documents")


def removed_lines(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(num, exact, near): places of the lines that each numbered document loses, as a copy and as similar to an earlier line."""
    rows = _hashes(line_rows(docs, text_col)).select("num", "pos", F.xxhash64("line").alias("lh"), "h")
    told = publish_hashes(rows, "line-words")
    lines = (told.agg(F.max("pos")).first()[0] or 0) + 1
    hashed = told.select("lh", _ord(lines).alias("ord"))
    twice = hashed.groupBy("lh").agg(F.min("ord").alias("first"), F.count("*").alias("n")).where("n > 1").select("lh", "first")
    copies = publish(hashed.join(_small(publish(twice, "line-twice"), F.lit(2)), "lh").where("ord <> first").select("ord"), "line-copies")
    words, classes = told.select(_ord(lines).alias("ord"), "h"), word_classes(told)
    if _few(copies, F.lit(1)):
        firsts = publish_hashes(prefixes(words.join(F.broadcast(copies), "ord", "left_anti"), classes), "line-firsts")
    else:  # a shuffle moves less of a line by its prefix
        whole = publish_hashes(prefixes(words, classes), "line-prefixes")
        firsts = publish_hashes(whole.join(copies, "ord", "left_anti"), "line-firsts")
        discard(whole)
    discard(told)

    led = _verified([publish(_leader_pairs(firsts), "line-leaders")], docs, text_col, lines)
    marked = firsts.join(_small(led.withColumn("open", F.lit(False)), F.lit(2)), "ord", "left").withColumn("open", F.coalesce("open", F.lit(True)))
    found = []
    for nth in range(ROUNDS):
        found.append(publish(_other_pairs(marked, nth), "line-pairs"))
        free(docs.sparkSession)
    near = led.unionByName(_verified(found, docs, text_col, lines))
    discard(firsts)

    lost = copies.withColumn("copy", F.lit(True)).unionByName(near.distinct().withColumn("copy", F.lit(False)))
    lost = lost.select(F.floor(F.col("ord") / F.lit(lines)).cast("long").alias("num"), (F.col("ord") % lines).cast("int").alias("pos"), "copy")
    return lost.groupBy("num").agg(F.collect_list(F.when(F.col("copy"), F.col("pos"))).alias("exact"), F.collect_list(F.when(~F.col("copy"), F.col("pos"))).alias("near"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with their texts' repeated lines removed, and n_lines, n_exact (copies removed) and n_near (similar lines removed)."""
    if clash := {*ADDED, "_num"} & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} would be overwritten")
    own = numbered(docs, id_col, text_col)
    lost = publish(removed_lines(own, text_col).withColumnsRenamed({"num": "_lost", "exact": "_exact", "near": "_near"}), "line-lost")
    both = own.join(_small(lost, F.size("_exact") + F.size("_near") + 4), F.col("_num") == F.col("_lost"), "left")
    lines = F.split(text_col, "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("_exact", i) & ~F.array_contains("_near", i)), "\n")
    text = F.when(F.col("_lost").isNull(), F.col(text_col)).otherwise(kept)
    counts = {"n_lines": F.coalesce(F.when(F.col(text_col).isNotNull(), F.size(lines)), F.lit(0)), "n_exact": F.coalesce(F.size("_exact"), F.lit(0)), "n_near": F.coalesce(F.size("_near"), F.lit(0))}
    return both.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns), *(v.cast("long").alias(k) for k, v in counts.items()))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with the lines that stay."""
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", *ADDED)


#: Word sets of all lines, compared where they share one of their rarest words (a quarter and one more), by all their words.
OP3_SQL = r"""
WITH l AS (
  SELECT doc_id, pos - 1 AS pos, trim(line, e' \t\x0b\x0c\r') AS line FROM (
    SELECT doc_id, unnest(string_split(text, e'\n')) AS line, generate_subscripts(string_split(text, e'\n'), 1) AS pos FROM documents)
), f AS (
  SELECT line, min((doc_id, pos)) AS first FROM l WHERE line <> '' GROUP BY line
), s AS (
  SELECT line, first, list_distinct(regexp_split_to_array(line, '[\x20\x09-\x0D]+')) AS w FROM f
), e AS (
  SELECT line, first, len(w) AS n, unnest(w) AS g FROM s
), d AS (
  SELECT g, count(*) AS df FROM e GROUP BY g
), r AS (
  SELECT line, first, n, g, row_number() OVER (PARTITION BY line ORDER BY df, g) AS i FROM e JOIN d USING (g)
), c AS (
  SELECT DISTINCT a.line AS a, b.line AS b FROM r a JOIN r b ON a.g = b.g AND b.first < a.first AND a.i <= a.n - ceil(0.75 * a.n) + 1 AND b.i <= b.n - ceil(0.75 * b.n) + 1
    AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
), p AS (
  SELECT a AS line FROM (SELECT a, len(x.w) + len(y.w) AS total, len(list_intersect(x.w, y.w)) AS o FROM c JOIN s x ON x.line = a JOIN s y ON y.line = b) WHERE 4 * o >= 3 * (total - o)
), q AS (
  SELECT doc_id, pos, (doc_id, pos) <> f.first AS copy, l.line IN (SELECT line FROM p) AS near FROM l JOIN f USING (line)
), g AS (
  SELECT doc_id, list(pos) AS lost, count(*) FILTER (copy) AS n_exact, count(*) FILTER (NOT copy) AS n_near FROM q WHERE copy OR near GROUP BY doc_id
)
SELECT doc_id, CASE WHEN lost IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, e'\n'), lambda x, i: NOT list_contains(lost, i - 1)), e'\n') END AS text,
  coalesce(len(string_split(text, e'\n')), 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near
FROM documents LEFT JOIN g USING (doc_id)
"""
