"""Language ID: interpolated Kneser-Ney character models in sorted hash arrays.

Training counts the character n-grams of the top order in the training texts, in the tasks that read them, and sums them by key. From
these sums follow, over all n-grams and before any of them is left out, the lower orders' continuation counts, the absolute discounts and
each context's total. A model is two sorted arrays an order, hash of the n-gram and its log probabilities by language, searched by
bisection. A text gets the language of lowest cross-entropy per character, and a softmax over the entropies as its score; `rejected` tells
that the score is below a threshold, or that no language explains the text. Temperature and thresholds are fitted on training texts that
the counts never saw, whole and cut to short pieces, as it is short texts that leave doubt.

A model keeps a language's most frequent n-grams of each order; how many grows with the square root of what was counted (see kept()). What
is left out is read from the order below: its context still gives up the whole mass, so that such n-grams lose only their own.

Cases: null texts, empty ones and ones without a letter are `und` with score 0; training rows without text or language are left
out; without any training row every text is `und`; a language whose only texts are held out for the fit is not learned; repeated rows are
scored alike; columns beyond those named are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import lowest_hashes, publish, table

#: Characters of the longest n-gram; n-grams of an order that a language keeps at least, and for each square root of a counted one; characters at a time.
ORDER, LEAST_NGRAMS, NGRAMS_GROWTH, CHUNK_CHARS = 4, 200_000, 100.0, 1_000_000
#: Of so many distinct training texts one is held out for the fit, which takes at most so many of them; lengths of the pieces cut from each.
HELD_OUT_ONE_IN, CALIBRATION_ROWS, PIECES = 20, 2_000, (4, 8, 16, 32, 64)
#: Share of right calibration texts that the threshold keeps.
KEEP = 0.995
UNKNOWN = "und"
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Code point to symbol: letters to themselves, folded to lower case, others to 32."""
    global _LETTERS
    if _LETTERS is None:
        fold = np.full(0x34000, 32, np.uint32)
        for i in range(0x34000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                fold[i] = ord(low) if len(low) == 1 else i
        _LETTERS = fold
    return _LETTERS


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, text of each): letters in lower case, each run of other characters one space."""
    joined = "\0".join(texts) + "\0"
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    fold = _letters()
    sym = fold[np.minimum(code, len(fold) - 1)]
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 32) | (sym[:-1] != 32)
    return sym[keep], np.repeat(np.arange(len(texts)), size)[keep]


def grams_of(sym: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The ORDER symbols that end at each place, 16 bits each; before a text stand spaces. Symbols beyond 16 bits keep their low ones."""
    out = sym.astype(np.uint64) & np.uint64(0xFFFF)
    part = out.copy()
    for j in range(1, min(ORDER, len(sym) + 1)):
        before = np.full(len(sym), 32, np.uint64)
        before[j:] = np.where(text[j:] == text[:-j], part[:-j], np.uint64(32))
        out |= before << np.uint64(16 * j)
    for j in range(len(sym) + 1, ORDER):
        out |= np.uint64(32 << (16 * j))
    return out


def _chunks(texts: list[str]) -> Iterator[slice]:
    begin = chars = 0
    for i, t in enumerate(texts):
        chars += len(t) + 1
        if chars >= CHUNK_CHARS:
            yield slice(begin, i + 1)
            begin, chars = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, symbols of an n-gram packed to two longs, count), summed within the task."""
    total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, keys: np.ndarray, counts: np.ndarray) -> None:
        if lang in total:
            keys, counts = np.concatenate([total[lang][0], keys]), np.concatenate([total[lang][1], counts])
            keys, back = np.unique(keys, return_inverse=True)
            counts = np.bincount(back, counts).astype(np.int64)
        total[lang] = keys, counts

    for batch in batches:
        texts, langs = np.array(batch.column(0).to_pylist(), object), np.array(batch.column(1).to_pylist(), object)
        for lang in sorted(set(langs.tolist())):
            own = texts[langs == lang].tolist()
            for part in _chunks(own):
                sym, text = symbols(own[part])
                keys, counts = np.unique(grams_of(sym, text), return_counts=True)
                add(lang, keys, counts)
    for lang, (keys, counts) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=["lang", "gram", "n"])


@dataclass
class Model:
    """keys[o]: sorted n-grams of order o + 1; logp[o]: their log probabilities, a column a language; back[o]: of contexts."""

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    context: list[np.ndarray]
    back: list[np.ndarray]
    floor: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    worst: float = float("inf")

    def score(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy in nats a symbol, texts by languages."""
        sym, text = symbols(texts)
        n = np.maximum(np.bincount(text, minlength=len(texts)), 1)
        # within a chunk an n-gram is looked up once
        grams, which = np.unique(grams_of(sym, text), return_inverse=True)
        value = self.lookup(grams)
        out = np.empty((len(texts), len(self.langs)))
        for j in range(len(self.langs)):
            out[:, j] = -np.bincount(text, value[which, j], len(texts)) / n
        return out

    def lookup(self, grams: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each n-gram after the others, by language."""
        out = np.zeros((len(grams), len(self.langs)))
        left = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            mask = np.uint64((1 << (16 * order)) - 1) if order < 4 else np.uint64(2**64 - 1)
            key = grams[left] & mask
            at = np.minimum(np.searchsorted(self.keys[order - 1], key), max(len(self.keys[order - 1]) - 1, 0))
            hit = self.keys[order - 1][at] == key if len(self.keys[order - 1]) else np.zeros(len(left), bool)
            out[left[hit]] += self.logp[order - 1][at[hit]]
            left, key = left[~hit], key[~hit]
            if not len(left):
                return out
            if order > 1:
                c = key >> np.uint64(16)
                at = np.minimum(np.searchsorted(self.context[order - 1], c), len(self.context[order - 1]) - 1)
                seen = self.context[order - 1][at] == c
                out[left[seen]] += self.back[order - 1][at[seen]]
        out[left] += self.floor
        return out


@dataclass
class Counts:
    """Of one language, by order: sorted n-grams with counts, the total and number of followers of their contexts, and the discount."""

    grams: list[np.ndarray]
    counts: list[np.ndarray]
    totals: list[np.ndarray]
    kinds: list[np.ndarray]
    discounts: list[float]
    symbols: int


def discount(ones: float, twos: float) -> float:
    return min(max(ones / (ones + 2 * twos), 0.1), 0.95) if ones else 0.5


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << (16 * order)) - 1) if order < 4 else np.uint64(2**64 - 1)


def count_orders(grams: np.ndarray, counts: np.ndarray) -> Counts:
    """All orders from the top one's n-grams: lower ones count the distinct symbols that precede. What train() does on tables, for arrays."""
    order = np.argsort(grams)
    levels = [(grams[order], counts[order].astype(float))]
    for o in range(ORDER - 1, 0, -1):
        keys, n = np.unique(levels[0][0] & _mask(o), return_counts=True)
        levels.insert(0, (keys, n.astype(float)))
    totals, kinds = [], []
    for o, (g, c) in enumerate(levels, 1):
        _, back = np.unique(g >> np.uint64(16) if o > 1 else np.zeros(len(g), np.uint64), return_inverse=True)
        totals.append(np.bincount(back, c)[back])
        kinds.append(np.bincount(back)[back].astype(float))
    d = [discount(float((c == 1).sum()), float((c == 2).sum())) for _, c in levels]
    return Counts([g for g, _ in levels], [c for _, c in levels], totals, kinds, d, len(levels[0][0]))


def probability(levels: list, order: int, keys: np.ndarray, floor: float) -> np.ndarray:
    """Probabilities of n-grams of an order in one language, from its ((n-grams, p), (contexts, weight)) by order; what is not there backs off."""
    (g, p), (ctx, weight) = levels[order - 1]
    at = np.minimum(np.searchsorted(g, keys), len(g) - 1)
    seen = g[at] == keys
    out = np.where(seen, p[at], floor)
    if order > 1 and not seen.all():
        rest = keys[~seen]
        c = np.minimum(np.searchsorted(ctx, rest >> np.uint64(16)), len(ctx) - 1)
        out[~seen] = np.where(ctx[c] == rest >> np.uint64(16), weight[c], 1.0) * probability(levels, order - 1, rest & _mask(order - 1), floor)
    return out


def kneser_ney(langs: list[str], tables: dict[str, Counts]) -> Model:
    """Model of each language's counts; n-grams pack 16 bits a symbol."""
    parts = []  # by language: by order: (grams, p), (contexts, weight); and the floor
    for lang in langs:
        t, own, floor = tables[lang], [], 1.0
        for o in range(1, ORDER + 1):
            g, c, d = t.grams[o - 1], t.counts[o - 1], t.discounts[o - 1]
            weight = d * t.kinds[o - 1] / t.totals[o - 1]
            if o == 1:
                floor = float(weight[0]) / (t.symbols + 1)  # of a symbol that the language never showed: its share of the unigrams' discount
                low = np.full(len(g), 1 / (t.symbols + 1))
            else:
                low = probability(own, o - 1, g & _mask(o - 1), floor)
            p = np.maximum(c - d, 0) / t.totals[o - 1] + weight * low
            ctx, first = np.unique(g >> np.uint64(16) if o > 1 else np.zeros(len(g), np.uint64), return_index=True)
            own.append(((g, p), (ctx, weight[first])))
        parts.append((own, floor))
    model = Model(langs, [], [], [], [], np.log(np.array([f for _, f in parts])))
    for o in range(ORDER):
        ctx = np.unique(np.concatenate([own[o][1][0] for own, _ in parts]))
        back = np.zeros((len(ctx), len(langs)))
        for j, (own, _) in enumerate(parts):
            back[np.searchsorted(ctx, own[o][1][0]), j] = np.log(own[o][1][1])
        model.context.append(ctx)
        model.back.append(back)
        keys = np.unique(np.concatenate([own[o][0][0] for own, _ in parts]))
        model.keys.append(keys)
        model.logp.append(np.stack([np.log(probability(own, o + 1, keys, floor)) for own, floor in parts], 1))
    return model


def pieces(text: str) -> list[str]:
    """The text, and a piece of each length in PIECES at a place that its hash chooses."""
    out, seed = [text], zlib.crc32(text.encode("utf-8", "surrogatepass"))
    for n in PIECES:
        if len(text) > n:
            at = seed * n % (len(text) - n)
            out.append(text[at : at + n])
    return out


def calibrate(model: Model, texts: list[str], langs: list[str]) -> Model:
    """Temperature of least log loss on labelled texts and their pieces, and thresholds that keep KEEP of the right whole texts."""
    known = [(piece, model.langs.index(lang), not i) for t, lang in zip(texts, langs, strict=True) if lang in model.langs and t for i, piece in enumerate(pieces(t)) if np.any(symbols([piece])[0] != 32)]
    if not known:
        return model
    own, right, whole = [t for t, _, _ in known], np.array([j for _, j, _ in known]), np.array([w for _, _, w in known])
    entropy = np.concatenate([model.score(own[part]) for part in _chunks(own)])
    best = None
    for temperature in np.geomspace(0.001, 10, 81):
        p = softmax(entropy, temperature)
        loss = -np.log(np.maximum(p[np.arange(len(right)), right], 1e-12)).mean()
        if best is None or loss < best[0]:
            best = loss, temperature, p
    model.temperature = float(best[1])
    good = (best[2].argmax(1) == right) & whole
    if good.any():
        model.threshold = float(np.quantile(best[2].max(1)[good], 1 - KEEP))
        model.worst = float(np.quantile(entropy.min(1)[good], KEEP)) * 1.25
    return model


def softmax(entropy: np.ndarray, temperature: float) -> np.ndarray:
    z = -(entropy - entropy.min(1, keepdims=True)) / temperature
    e = np.exp(z)
    return e / e.sum(1, keepdims=True)


def kept(counted: int, least: int = LEAST_NGRAMS, growth: float = NGRAMS_GROWTH) -> int:
    """How many n-grams of an order a language keeps, of so many counted ones: it grows with the corpus, as vocabularies do, and slower than it."""
    return max(least, int(growth * counted**0.5))


def count_tables(rows: DataFrame, least: int = LEAST_NGRAMS, growth: float = NGRAMS_GROWTH) -> dict[str, Counts]:
    """Counts of each language in (text, lang) rows. Sums, continuation counts, contexts and discounts cover every n-gram and are made by
    aggregation; what reaches the driver is bounded by kept()."""
    level = publish(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-counts")
    found: dict[str, list] = {}
    for o in range(ORDER, 0, -1):
        if o < ORDER:
            level = publish(level.groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << (16 * o)) - 1)).alias("gram")).agg(F.count("*").alias("n")), "language-counts")
        facts = level.groupBy("lang").agg(F.sum("n").alias("counted"), F.count("*").alias("grams"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos")).collect()  # one row a language
        of = {r["lang"]: r for r in facts}
        full = {lang: most for lang, r in of.items() if r["grams"] > (most := kept(r["counted"], least, growth))}
        low = F.lit(1)
        for lang, most in full.items():  # the least count that fits, from how many n-grams have each
            by = level.where(F.col("lang") == lang).groupBy("n").agg(F.count("*").alias("g")).orderBy(F.desc("n")).withColumn("g", F.sum("g").over(Window.orderBy(F.desc("n")))).where(F.col("g") <= most)
            low = F.when(F.col("lang") == lang, F.lit(by.agg(F.min("n")).first()[0] or 2**62)).otherwise(low)
        context = F.shiftrightunsigned("gram", 16) if o > 1 else F.lit(0).cast("long")
        keyed = level.withColumn("ctx", context)
        totals = keyed.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
        top = keyed.where(F.col("n") >= low).join(totals, ["lang", "ctx"]).select("lang", "gram", "n", "total", "kinds").toArrow()
        names = np.array(top["lang"].to_pylist(), object)
        grams = top["gram"].to_numpy().view(np.uint64)
        for lang, r in of.items():
            at = np.flatnonzero(names == lang)
            at = at[np.argsort(grams[at])]
            found.setdefault(lang, []).insert(0, (grams[at], *(top[c].to_numpy()[at].astype(float) for c in ("n", "total", "kinds")), discount(r["ones"], r["twos"]), r["grams"]))
    return {lang: Counts(*(list(c) for c in list(zip(*levels, strict=True))[:5]), levels[0][5]) for lang, levels in found.items()}


def train(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_NGRAMS, growth: float = NGRAMS_GROWTH) -> Model | None:
    """Counts cover the training rows but for one distinct text in HELD_OUT_ONE_IN, which fit temperature and thresholds, CALIBRATION_ROWS of them at most."""
    rows = docs.where(training & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    aside = F.pmod(F.xxhash64("text"), F.lit(HELD_OUT_ONE_IN)) == 0
    tables = count_tables(rows.where(~aside), least, growth)
    if not tables:
        return None
    langs = sorted(tables)
    model = kneser_ney(langs, tables)
    keyed = publish(rows.where(aside).select(F.xxhash64("text", "lang").alias("key")).distinct(), "language-held-out")
    last = keyed.where(F.col("key") <= F.lit(lowest_hashes(CALIBRATION_ROWS, keyed.count()))).orderBy("key").limit(CALIBRATION_ROWS).agg(F.max("key")).first()[0]
    if last is None:
        return model
    own = F.xxhash64("text", "lang")
    sample = rows.where(aside & (own <= F.lit(last))).groupBy(own.alias("key")).agg(F.first("text").alias("text"), F.first("lang").alias("lang")).orderBy("key").limit(CALIBRATION_ROWS).collect()
    return calibrate(model, [r["text"] for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, entropy, rejected) of each row; only the text takes part."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)  # bounded by kept(): n-grams of a language and order, times languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in _chunks(texts):
                own = texts[part]
                sym, text = symbols(own)
                letter = np.bincount(text, sym != 32, len(own)) > 0
                if m is None:
                    pred, score, entropy, rejected = [UNKNOWN] * len(own), np.zeros(len(own)), np.zeros(len(own)), np.ones(len(own), bool)
                else:
                    h = m.score(own)
                    p = softmax(h, m.temperature)
                    best = p.argmax(1)
                    score, entropy = np.where(letter, p.max(1), 0.0), np.where(letter, h.min(1), 0.0)
                    pred = [m.langs[j] if ok else UNKNOWN for j, ok in zip(best.tolist(), letter.tolist(), strict=True)]
                    rejected = ~letter | (score < m.threshold) | (entropy > m.worst)
                ids = batch.column(0).slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(pred, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)], names=["id", "lang_pred", "score", "entropy", "rejected"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, entropy double, rejected boolean")


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from documents whose crc32(doc_id) mod 3 is not 1, predicts all."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, train(docs, ~held_out()))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
