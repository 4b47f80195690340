"""Secret scans: fixed patterns, and a character convolutional network over every candidate and its context.

Candidates are what the patterns find, runs of 16 or more token characters, and what the patterns leave of one. The network (one convolution,
maximum and mean over places, a logistic unit) sees a candidate between the characters before and after it, long ones window by
window, a bounded number of windows at a time. It is trained in numpy on labelled findings made by rule: random keys in the shapes
that services issue, against e-mail hosts, card and phone numbers, addresses, paths, versions, identifiers and words. Candidates are of
three classes (digits, letters, both); each class has its own threshold, the highest one that still recalls RECALL of its held-out
positives, and a class that never held a secret has none. Candidates above it are added as kind `cnn`; spans of the patterns always
stay, whatever their score.

Cases: null text counts as empty and has no spans; spans are code points, end exclusive; of one kind they never overlap; very
long texts and very long runs are scanned whole; repeated rows are scanned alike; columns beyond id and text are ignored.
"""

from __future__ import annotations

import functools
import itertools
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: Fixed: the patterns and the order of kinds.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # a maximal run of 32 or more is what leftmost matching finds, too
KINDS = ("assign", "access", "hex", "cnn")
LEAST, JOINS = 16, "/_=.-"
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.\-]{{{LEAST},}}")
#: Characters of context before, of the candidate at a time, and after; filters; filter width; size of an embedding.
BEFORE, WINDOW, AFTER, FILTERS, WIDTH, EMBED = 24, 48, 8, 16, 5, 8
#: Labelled findings that are made, passes over them, share of held-out positives that a threshold must recall, windows scored at a time.
FINDINGS, EPOCHS, RECALL, MOST_WINDOWS = 6000, 5, 0.97, 512
CLASSES = ("digits", "letters", "both")
_ALPHABET = string.ascii_letters + string.digits + "+/_=.-:;,\"'@ ()<>\n"
_CODE = np.full(0x250, len(_ALPHABET) + 1, np.int64)  # other letters and signs share one code; 0 pads
for _i, _c in enumerate(_ALPHABET, 1):
    _CODE[ord(_c)] = _i
_SYMBOLS = len(_ALPHABET) + 2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of what the fixed patterns find."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs, and of those that patterns cover in part what is left, without one joining sign at the cut."""
    found = [(m.start(), m.end()) for m in CANDIDATE.finditer(text)]
    if not base:
        return found
    out = []
    for s, e in found:
        at, cut = s, False
        for bs, be in [*((bs, be) for bs, _, be in base if s < be and bs < e), (e, e)]:  # by start
            left, right = at + (cut and at < bs and text[at] in JOINS), min(bs, e)
            right -= bs < e and right > left and text[right - 1] in JOINS
            if right - left >= (LEAST if cut or bs < e else 1):
                out.append((left, right))
            at, cut = max(at, be), True
    return out


def class_of(value: str) -> int:
    """Place in CLASSES: by whether a candidate has digits, letters or both."""
    digits, letters = any("0" <= c <= "9" for c in value), any("a" <= c.lower() <= "z" for c in value)
    return 2 if digits and letters else 0 if digits else 1


def windows(text: str, start: int, end: int) -> Iterator[str]:
    """What the network sees of a candidate: its context and a window of it, as often as its length needs."""
    for s in range(start, max(start + 1, end - WINDOW // 2), WINDOW // 2):
        before = text[max(0, s - BEFORE) : s].rjust(BEFORE, "\0")
        yield before + text[s : min(end, s + WINDOW)].ljust(WINDOW, "\0") + text[min(end, s + WINDOW) : min(end, s + WINDOW) + AFTER].ljust(AFTER, "\0")


def codes(items: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(items).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(items), -1)
    return np.where(raw == 0, 0, _CODE[np.minimum(raw, len(_CODE) - 1)])


@dataclass
class Network:
    embed: np.ndarray  # symbols x EMBED
    conv: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray
    out: np.ndarray  # 2 * FILTERS + 1, the last one a bias
    thresholds: tuple[float, ...] = (0.5, 0.5, 0.5)  # by class of candidate

    def _maps(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = self.embed[x]
        n = x.shape[1] - WIDTH + 1
        cols = np.concatenate([e[:, j : j + n] for j in range(WIDTH)], 2)
        return cols, np.maximum(cols @ self.conv + self.bias, 0)

    def score(self, x: np.ndarray) -> np.ndarray:
        scores = [np.empty(0)]
        for i in range(0, len(x), 256):
            _, a = self._maps(x[i : i + 256])
            scores.append(1 / (1 + np.exp(-(np.concatenate([a.max(1), a.mean(1)], 1) @ self.out[:-1] + self.out[-1]))))
        return np.concatenate(scores)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        cols, a = self._maps(x)
        top = a.argmax(1)
        pooled = np.concatenate([a.max(1), a.mean(1)], 1)
        d = (1 / (1 + np.exp(-(pooled @ self.out[:-1] + self.out[-1]))) - y) / len(y)
        d_pool = d[:, None] * self.out[:-1]
        d_a = np.repeat(d_pool[:, None, FILTERS:] / a.shape[1], a.shape[1], 1)
        d_a[np.arange(len(x))[:, None], top, np.arange(FILTERS)] += d_pool[:, :FILTERS]
        d_a *= a > 0
        d_conv = cols.reshape(-1, WIDTH * EMBED).T @ d_a.reshape(-1, FILTERS)
        d_cols = d_a @ self.conv.T
        n, d_e = a.shape[1], np.zeros((*x.shape, EMBED), np.float32)
        for j in range(WIDTH):
            d_e[:, j : j + n] += d_cols[:, :, j * EMBED : (j + 1) * EMBED]
        d_embed = np.eye(_SYMBOLS, dtype=np.float32)[x.ravel()].T @ d_e.reshape(-1, EMBED)
        return [d_embed, d_conv, d_a.sum((0, 1)), np.append(pooled.T @ d, d.sum())]


def findings(rng: np.random.Generator, n: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Labelled windows and their classes: half of them secrets, half look-alikes, in made-up prose."""
    pick = lambda chars, k: "".join(rng.choice(list(chars), k))
    syllables = ["an", "er", "the", "ion", "in", "es", "ou", "re", "st", "ha", "be", "de", "la", "que", "sch", "ung", "ent", "os", "ble", "ly"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 5)))
    parts = [*syllables, "lich", "keit", "heit", "ver", "ein", "die", "und", "ment", "eur", "eau", "aire", "ado", "dad", "cion", "ness", "ship", "ful", "pre", "pro", "con", "ge", "auf", "pf", "ch"]
    longer = lambda: "".join(rng.choice(parts, rng.integers(4, 9)))
    both, lower, upper, hexa, digit = string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits, "0123456789abcdef", string.digits
    secrets = [
        lambda: pick(both, rng.integers(20, 65)), lambda: pick(both + "+/", rng.integers(20, 65)) + "=" * int(rng.integers(0, 3)), lambda: pick(upper, rng.integers(20, 41)), lambda: pick(hexa, rng.integers(20, 32)),
        lambda: f"ghp_{pick(both, 36)}", lambda: f"xoxb-{pick(digit, 11)}-{pick(both, 24)}", lambda: f"sk_live_{pick(both, 24)}", lambda: f"eyJ{pick(both + '_-', 30)}.{pick(both + '_-', 40)}.{pick(both + '_-', 30)}", lambda: pick(lower, rng.integers(24, 48)), lambda: pick(both + "_-", rng.integers(22, 50)),
        lambda: pick([string.ascii_letters, string.ascii_lowercase, string.ascii_uppercase][rng.integers(0, 3)], rng.integers(16, 41)),
    ]
    others = [
        lambda: pick(digit, rng.integers(16, 20)), lambda: f"{pick(string.ascii_lowercase, rng.integers(3, 9))}.{rng.integers(0, 99)}@{rng.choice(['mail', 'mx', 'smtp', 'host'])}{rng.integers(0, 99)}.{rng.choice(['example', word(), word() + '-' + word()])}.{rng.choice(['com', 'org', 'net', 'de', 'co.uk'])}", lambda: f"www{rng.integers(0, 9)}.{word()}.{rng.choice(['com', 'net', 'fr'])}", lambda: f"{word()}.{rng.integers(0, 99)}.{word()}.example.org", lambda: "-".join([pick(digit, 4)] * 4), lambda: f"{rng.integers(1990, 2030)}-0{rng.integers(1, 9)}-{rng.integers(10, 28)}.{word()}{word()}",
        lambda: f"/{word()}/{word()}/{rng.integers(0, 9999)}/{word()}.html", lambda: f"{word()}_{word()}_{word()}_{rng.integers(0, 99)}", lambda: f"{word().title()}{word().title()}{word().title()}{rng.integers(0, 999)}", lambda: f"{word()}-{word()}-{rng.integers(0, 9999)}-{word()}", lambda: f"{word()}.{word()}.v{rng.integers(0, 9)}.{rng.integers(0, 9)}.{rng.integers(0, 99)}", lambda: word() * 4 + str(rng.integers(0, 99)), lambda: "=" * int(rng.integers(16, 30)) + str(rng.integers(0, 9)),
        lambda: str(rng.choice(["-", "_", ".", "=", "/", ""])).join(word() for _ in range(rng.integers(4, 9))), lambda: str(rng.choice(list("=-._+"))) * int(rng.integers(16, 80)), lambda: f"www.{word()}{word()}.{rng.choice(['com', 'net', 'fr'])}/{word()}/{word()}", lambda: "".join(word().title() for _ in range(rng.integers(4, 8))),
        lambda: longer(), lambda: longer().title(), lambda: longer().upper() + str(rng.choice(["", ".", "-", "..."])),
    ]
    leads = ["key: ", "auth ", "Bearer ", "client_id=", "credential ", "", "", "", "", "see ", "at ", "host ", "id ", "no. ", "call ", "of "]
    items, labels, kinds = [], [], []
    while len(items) < n:
        label = int(rng.integers(0, 2))
        make = secrets if label else others
        value = make[rng.integers(0, len(make))]()
        text = " ".join(word() for _ in range(5)) + " " + str(rng.choice(leads)) + value + " " + " ".join(word() for _ in range(2))
        at = text.index(value)
        found = [(b, e) for b, e in candidates(text, base_spans(text)) if b <= at + len(value) - 1 and e > at]
        for s, e in found[:1]:
            items.append(next(windows(text, s, e)))
            labels.append(label)
            kinds.append(class_of(text[s:e]))
    return items, np.array(labels, float), np.array(kinds)


@functools.lru_cache(maxsize=1)
def trained(seed: int = 7) -> Network:
    """The network, trained with Adam and calibrated on a fifth of the findings that training never saw."""
    rng = np.random.default_rng(seed)
    items, y, kinds = findings(rng, FINDINGS)
    x, y = codes(items), y.astype(np.float32)
    cut = len(x) * 4 // 5
    net = Network(*(w.astype(np.float32) for w in (rng.normal(0, 0.5, (_SYMBOLS, EMBED)), rng.normal(0, 0.2, (WIDTH * EMBED, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.3, 2 * FILTERS + 1))))
    weights = [net.embed, net.conv, net.bias, net.out]
    mean, var, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(cut)
        for i in range(0, cut, 64):
            step += 1
            rows = order[i : i + 64]
            for w, g, m, v in zip(weights, net.gradients(x[rows], y[rows]), mean, var, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.thresholds = calibrated(net.score(x[cut:]), y[cut:], kinds[cut:])
    return net


def calibrated(score: np.ndarray, y: np.ndarray, kinds: np.ndarray) -> tuple[float, ...]:
    """By class, the highest threshold that recalls RECALL of the positives; beyond any score where a class has none."""
    own = [np.sort(score[(y == 1) & (kinds == k)]) for k in range(len(CLASSES))]
    return tuple(float(p[int((1 - RECALL) * len(p))]) if len(p) else 2.0 for p in own)


def scores(text: str, spans: list[tuple[int, int]], net: Network) -> np.ndarray:
    """The highest score of each span's windows; MOST_WINDOWS of them are held at a time, however long a span is."""
    best = np.zeros(len(spans))
    seen = ((i, w) for i, (s, e) in enumerate(spans) for w in windows(text, s, e))
    while part := list(itertools.islice(seen, MOST_WINDOWS)):
        np.maximum.at(best, [i for i, _ in part], net.score(codes([w for _, w in part])))
    return best


def scan_text(text: str, net: Network) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of all findings, by start, then kind."""
    base = base_spans(text)
    free = candidates(text, base)
    if not base and not free:
        return []
    p = scores(text, [(s, e) for s, _, e in base] + free, net).tolist()
    out = [(s, k, e, x) for (s, k, e), x in zip(base, p, strict=False)]
    out += [(s, 3, e, x) for (s, e), x in zip(free, p[len(base) :], strict=True) if x >= net.thresholds[class_of(text[s:e])]]
    return sorted(out)


def scan(docs: DataFrame, net: Network | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of each row: spans are structs (kind, start, end, score), by start, then kind."""
    kind = docs.schema[id_col].dataType.simpleString()
    net = net or trained()
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in scan_text(t or "", shared.value)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def _digests(found: DataFrame) -> tuple[dict, dict]:
    """Columns from spans: of the patterns, and of all of them."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, one), ",")
    base = F.filter("spans", lambda s: s["kind"] != "cnn")
    return {f"n_{k}": of(k) for k in KINDS[:3]} | {"base_sha256": F.sha2(joined(base), 256)}, {"spans": joined(F.col("spans")), "n_cnn": of("cnn")}


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, whole texts."""
    found = scan(table(spark, sf_dir, "documents"))
    base, more = _digests(found)
    return found.select(F.col("id").alias("doc_id"), *(c.alias(n) for n, c in (base | more).items()))


def secret_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op5_secret_scan that SQL can express: what the fixed patterns find, from the same scan."""
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), *(c.alias(n) for n, c in _digests(found)[0].items()))


#: Letters of the first pattern's words in either case, without a flag that would fold beyond ASCII.
_WORDS = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
#: Matches in order; each is found again behind the end of the one before it, which gives its place.
SECRET_PATTERNS_SQL = rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), m AS (
  SELECT doc_id, text, 0 AS kind, regexp_extract_all(text, '(?:{_WORDS})["'']? *[:=] *["'']?[A-Za-z0-9+/_.=-]+') AS m FROM t
  UNION ALL SELECT doc_id, text, 1, regexp_extract_all(text, 'AKIA[A-Z0-9]+') FROM t
  UNION ALL SELECT doc_id, text, 2, regexp_extract_all(text, '[0-9a-f]{{32,}}') FROM t
), r AS (
  SELECT doc_id, kind, m, text, 0 AS i, 0::BIGINT AS s, 0::BIGINT AS e FROM m WHERE len(m) > 0
  UNION ALL
  SELECT doc_id, kind, m, text, i + 1, e + instr(substr(text, e + 1), m[i + 1]) - 1, e + instr(substr(text, e + 1), m[i + 1]) - 1 + length(m[i + 1]) FROM r WHERE i < len(m)
), f AS (
  SELECT doc_id, kind, s, e FROM r WHERE i > 0 AND CASE kind WHEN 0 THEN length(regexp_extract(m[i], '^(?:{_WORDS})["'']? *[:=] *["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 8 WHEN 1 THEN e - s >= 16 ELSE e - s >= 32 END
), g AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS b, count(*) FILTER (kind = 2) AS c,
    string_agg(CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' ELSE 'hex' END || ':' || s || ':' || e, ',' ORDER BY s, kind) AS j
  FROM f GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(j, '')) AS base_sha256 FROM documents LEFT JOIN g USING (doc_id)
"""
