"""Secrets: fixed patterns, and strings that a battery of randomness tests can't tell from noise.

Candidates are runs of encoded characters, and the parts that separators cut them into.
The encoding (digits, hex, letters, base32, alphanumeric, base64) is inferred from the
characters used.  Runs whose shares of digits, capitals, small letters and signs next to no
uniform string has (``ODD_SHARES``) are none.  Three tests take the string as independent
uniform symbols of that alphabet:

* chi-squared: the counts of the symbols, one by one and in bins of equal probability;
* runs: how often the symbol value crosses the alphabet's middle (Wald-Wolfowitz);
* serial correlation: of neighbouring symbol values at lag one.

A candidate's p-value is Bonferroni's over them.  Over all candidates of the corpus,
Benjamini-Hochberg at ``FDR`` within each length class says which are *not* random; the
classes share the rate in proportion to nothing but their own candidates, so that many
short strings, for which the tests have little power, don't set the bar for long ones.
Candidates that are not rejected are secrets, if they are long enough that text in their
alphabet would have been (``MIN_CHARS``) and every test had symbols to work on.

That control bounds noise taken for text.  The other side, words taken for noise, concerns strings of
letters only, for which the three tests have little power: such a string is none if the letter pairs
of the corpus's own words make it likelier than uniform draws do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import as_texts, id_and_text, slices
from sensorflow.session import staged

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "api")

#: least length of a candidate; below it text in the same alphabet often passes all tests
MIN_CHARS = 20
#: lengths of a class share one false-discovery control
LENGTH_CLASSES = (20, 28, 40, 64, 128)
FDR = 0.05
#: p-values are counted in bins of equal width on a log scale
P_BINS, P_DECADES = 200, 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_CHARS)
#: parts of a candidate that hold these signs only, as an encoding may use them, and the others separate
PARTS = [re.compile(r"[A-Za-z0-9%s]{%d,}={0,2}" % (signs, MIN_CHARS)) for signs in ("+/", "_-", "+", "_", "-", "")]
#: share of the uniform strings of an alphabet, at most, that count as too oddly composed to be tested
ODD_SHARES = 1e-4

DIGIT_SYMBOLS = "0123456789"
LETTER_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
HEX_SYMBOLS = "0123456789abcdef"
BASE32_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ALNUM_SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE64_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
LOWER_SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyz"

#: text bytes whose letter pairs a task counts at once: the arrays for it take some 40 times as much
PAIR_BYTES = 1 << 18


def infer_encoding(s: str) -> str:
    """Symbols, in value order, of the narrowest encoding that ``s`` fits."""
    used = set(s)
    for symbols in (DIGIT_SYMBOLS, HEX_SYMBOLS, HEX_SYMBOLS.upper(), LETTER_SYMBOLS[26:], LETTER_SYMBOLS[:26],
                    BASE32_SYMBOLS, LOWER_SYMBOLS, LOWER_SYMBOLS.upper(), LETTER_SYMBOLS, ALNUM_SYMBOLS):
        if used <= set(symbols):
            return symbols
    return BASE64_SYMBOLS + ("+/" if used & set("+/") else "-_")


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function (series below a + 1, continued fraction above)."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1 - scale * total)
    b = x + 1 - a
    c, d = 1e300, 1 / b
    h = d
    for i in range(1, 500):
        b += 2
        d = 1 / (b - i * (i - a) * d)
        c = b - i * (i - a) / c
        h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return min(1.0, scale * h)


def two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def binomial_tail(x: int, n: int, p: float) -> float:
    """Chance of a count as far out as ``x`` on its side of the mean, of ``n`` draws."""
    if not 0 < p < 1:
        return float(x == n * p)
    step = -1 if x <= n * p else 1
    term = math.exp(math.lgamma(n + 1) - math.lgamma(x + 1) - math.lgamma(n - x + 1)
                    + x * math.log(p) + (n - x) * math.log1p(-p))
    total = 0.0
    while 0 <= x <= n and term > total * 1e-15:
        total += term
        term *= x * (1 - p) / ((n - x + 1) * p) if step < 0 else (n - x) * p / ((x + 1) * (1 - p))
        x += step
    return total


def oddly_composed(s: str) -> bool:
    """Whether no more than ``ODD_SHARES`` of uniform strings have such numbers of characters of the four kinds.

    So has a string that mixes the signs of two encodings.
    """
    s = s.rstrip("=")
    symbols = infer_encoding(s)
    if not set(s) <= set(symbols):
        return True
    digits, capitals, small = str.isdigit, str.isupper, str.islower
    signs = lambda c: not c.isalnum()
    # each way to part the kinds in two
    parted = [(digits,), (capitals,), (small,), (signs,), (digits, capitals), (digits, small), (digits, signs)]
    for kinds in parted:
        share = sum(any(k(c) for k in kinds) for c in symbols) / len(symbols)
        if binomial_tail(sum(any(k(c) for k in kinds) for c in s), len(s), share) < ODD_SHARES / (2 * len(parted)):
            return True
    return False


def p_value(s: str) -> float:
    """Smallest p-value of the tests times their number, at most 1; 0 where a test has nothing to work on."""
    s = s.rstrip("=")
    symbols = infer_encoding(s)
    n, k = len(s), len(symbols)
    value = np.array([symbols.index(c) for c in s], float)
    bins = max(2, min(k, n // 5))
    edges = np.floor(value * bins / k).astype(int)
    width = np.bincount(np.floor(np.arange(k) * bins / k).astype(int), minlength=bins) / k
    expected = n * width
    chi2 = float(((np.bincount(edges, minlength=bins) - expected) ** 2 / expected).sum())
    uniform = upper_gamma((bins - 1) / 2, chi2 / 2)
    # by symbol, where counts are too small for the limit: a gamma law of the same mean and variance
    chi2 = float(((np.bincount(value.astype(int), minlength=k) - n / k) ** 2).sum() * k / n)
    single = upper_gamma((k - 1) / 2 * n / (n - 1), chi2 / 2 * n / (n - 1))

    high = value >= k / 2
    a, b = int(high.sum()), int(n - high.sum())
    if not a or not b or value.std() == 0:
        return 0.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * a * b / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs_p = two_sided((runs - mean) / math.sqrt(var)) if var > 0 else 0.0

    r = float(np.corrcoef(value[:-1], value[1:])[0, 1]) if value[:-1].std() and value[1:].std() else 1.0
    serial = two_sided((r + 1 / (n - 1)) * math.sqrt(n))
    return min(1.0, 4 * min(uniform, single, runs_p, serial))


def blocks(raw: bytes, size: int = PAIR_BYTES) -> Iterator[np.ndarray]:
    """``raw``, which ends in a space, cut after spaces into parts of about ``size`` bytes: no word is cut."""
    at = 0
    while at < len(raw):
        end = raw.index(b" ", min(at + size, len(raw)) - 1) + 1
        yield np.frombuffer(raw, np.uint8, end - at, at)
        at = end


def pair_counts(raw: np.ndarray) -> np.ndarray:
    """How often each pair of small letters stands in words shorter than a candidate; the last byte is no letter."""
    letter = (raw >= 97) & (raw <= 122)
    edge = np.flatnonzero(np.diff(letter.astype(np.int8), prepend=0, append=0))
    first, size = edge[::2], edge[1::2] - edge[::2]
    short = np.zeros(len(raw) + 1, np.int8)
    ok = size < MIN_CHARS
    np.add.at(short, first[ok], 1)
    np.add.at(short, first[ok] + size[ok] - 1, -1)  # the last letter begins no pair
    at = np.flatnonzero(np.cumsum(short[:-1], dtype=np.int8))
    return np.bincount((raw[at].astype(np.int64) - 97) * 26 + raw[at + 1] - 97, minlength=26 * 26)


def letter_pairs(docs: DataFrame) -> np.ndarray:
    """``log(26 * P(b | a))`` of letters a, b (case ignored) in words shorter than a candidate, over all texts.

    One pass that counts by task; ``26 * 26`` numbers reach the driver.  0 for letters that never occur.
    """

    def count(batches):
        total = np.zeros(26 * 26, np.int64)
        for piece in slices(batches, max_bytes=PAIR_BYTES):
            for raw in blocks(" ".join(as_texts(piece.column("text"))).lower().encode("ascii", "replace") + b" "):
                total += pair_counts(raw)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(26 * 26)), pa.array(total)], ["pair", "n"])

    n = np.zeros(26 * 26)
    for r in id_and_text(docs).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        n[r["pair"]] = r["n"]
    n = n.reshape(26, 26)
    return np.log(26 * (n + 1) / (n.sum(1, keepdims=True) + 26))


def reads_like_words(s: str, pairs: np.ndarray) -> bool:
    """Whether a string of letters is likelier by the corpus's letter pairs than by uniform draws."""
    if not s.isalpha():
        return False
    x = np.frombuffer(s.lower().encode(), np.uint8).astype(np.int64) - 97
    return float(pairs[x[:-1], x[1:]].sum()) > 0


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the fixed patterns, leftmost and non-overlapping per kind."""
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1])))


def candidates(text: str, pairs: np.ndarray) -> list[tuple[int, int, float]]:
    """``(start, end, p)`` of the strings that may be random, parts of longer ones included; ``pairs``: :func:`letter_pairs`."""
    out = []
    for m in CANDIDATE.finditer(text):
        places = {m.span()}
        if not m[0].isalnum():
            places |= {(m.start() + part.start(), m.start() + part.end()) for p in PARTS for part in p.finditer(m[0])}
        out += [(a, b, p_value(text[a:b])) for a, b in sorted(places)
                if not oddly_composed(text[a:b]) and not reads_like_words(text[a:b], pairs)]
    return out


SPANS = "array<struct<start:long,kind:string,end:long>>"
SCANNED = f"doc_id long, base {SPANS}, found array<struct<start:long,end:long,p:double>>"


def scan(docs: DataFrame, pairs: np.ndarray) -> DataFrame:
    """``doc_id, base, found``: pattern spans and tested candidates of every whole text, in code points."""

    def find(batches):
        for piece in slices(batches):
            texts = as_texts(piece.column("text"))
            base = [[{"start": a, "kind": k, "end": b} for a, k, b in base_spans(t)] for t in texts]
            found = [[{"start": a, "end": b, "p": p} for a, b, p in candidates(t, pairs)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"),
                 pa.array(base, pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))],
                ["doc_id", "base", "found"])

    return id_and_text(docs).mapInArrow(find, SCANNED)


def length_class(chars: Column) -> Column:
    c = F.lit(0)
    for i, least in enumerate(LENGTH_CLASSES):
        c = F.when(chars >= least, i).otherwise(c)
    return c


def p_bin(p: Column) -> Column:
    """0 for the smallest p-values, up to ``P_BINS`` for 1."""
    at = F.floor((F.log10(F.greatest(p, F.lit(10.0 ** -P_DECADES))) / P_DECADES + 1) * P_BINS)
    return F.least(at, F.lit(P_BINS)).cast("int")


def rejected_bins(scanned: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Per length class, the last bin of p-values that Benjamini-Hochberg rejects (-1: none).

    A bin stands for its upper edge, which errs towards not rejecting.  Gathers one count
    per class and bin: ``len(LENGTH_CLASSES) * (P_BINS + 1)`` rows at most.
    """
    counts = (scanned.select(F.explode("found").alias("c"))
              .groupBy(length_class(F.col("c.end") - F.col("c.start")).alias("class"), p_bin(F.col("c.p")).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")).collect())
    last = {}
    for cls in range(len(LENGTH_CLASSES)):
        n = np.zeros(P_BINS + 1)
        for r in counts:
            if r["class"] == cls:
                n[r["bin"]] += r["n"]
        edge = np.minimum(1.0, 10.0 ** (((np.arange(P_BINS + 1) + 1) / P_BINS - 1) * P_DECADES))
        ok = np.flatnonzero((n.cumsum() > 0) & (edge * n.sum() <= fdr * n.cumsum()))
        last[cls] = int(ok[-1]) if len(ok) else -1
    return last


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """``doc_id, base, spans``: pattern spans, and all spans with kind ``random`` for the tested ones.

    Spans are in code points, end exclusive, by start, then kind.  A random span that lies
    within a pattern span or a longer random one is left out.  A null text is empty and has no spans; null and
    repeated ids give one row per input row; an empty table gives no rows.
    """
    scanned = staged(scan(docs, letter_pairs(docs)), "secrets")
    last = rejected_bins(scanned, fdr)

    def finish(batches):
        for piece in slices(batches, "found"):
            base, found = piece.column("base").to_pylist(), piece.column("found").to_pylist()
            spans = [merged([(s["start"], s["kind"], s["end"]) for s in bs], [(c["start"], c["end"], c["p"]) for c in cs], last)
                     for bs, cs in zip(base, found)]
            rows = [[{"start": a, "kind": k, "end": b} for a, k, b in ss] for ss in spans]
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("base"), pa.array(rows, piece.schema.field("base").type)],
                                             ["doc_id", "base", "spans"])

    return scanned.mapInArrow(finish, f"doc_id long, base {SPANS}, spans {SPANS}")


def bin_of(p: float) -> int:
    """:func:`p_bin` of one value."""
    return min(P_BINS, math.floor((math.log10(max(p, 10.0 ** -P_DECADES)) / P_DECADES + 1) * P_BINS))


def passes(start: int, end: int, p: float, last: dict[int, int]) -> bool:
    return p > 0 and bin_of(p) > last[sum(end - start >= x for x in LENGTH_CLASSES) - 1]


def merged(base: list[tuple[int, str, int]], found: list[tuple[int, int, float]], last: dict[int, int]) -> list[tuple[int, str, int]]:
    """Base spans and the candidates that pass, without those inside a base span or a longer one: one sorted sweep."""
    events = [(a, -b, 0, k) for a, k, b in base] + [(a, -b, 1, "random") for a, b, p in found if passes(a, b, p, last)]
    out, reach = [], -1
    for a, b, is_random, kind in sorted(events):
        # what came before starts at or before this one, and reaches as far as this one's end or not
        if not is_random or reach < -b:
            out.append((a, kind, -b))
            reach = max(reach, -b)
    rank = {k: i for i, k in enumerate((*KINDS, "random"))}
    return sorted(out, key=lambda s: (s[0], rank[s[1]]))


def span_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def with_digests(found: DataFrame) -> DataFrame:
    """Counts and joined spans of :func:`find_secrets` rows."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(span_text("base"), 256).alias("base_sha256"),
                        span_text("spans").alias("spans"))


def redact(docs: DataFrame, fdr: float = FDR, mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; other columns, and null texts, as they were.

    Overlapping spans are replaced as one.  The letter pairs and the false-discovery bars come from a
    pass each over all texts, another pass applies them in place: no text is shuffled.  Rows with null or
    repeated ids are rows like others; an empty table gives an empty one.
    """
    pairs = letter_pairs(docs)
    last = rejected_bins(staged(scan(docs, pairs), "secrets"), fdr)
    schema = docs.schema

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        spans = [(a, b) for a, _, b in base_spans(text)]
        spans += [(a, b) for a, b, p in candidates(text, pairs) if passes(a, b, p, last)]
        out, at = [], 0
        for a, b in sorted(spans):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join([*out, text[at:]])

    def rewrite(batches):
        for piece in slices(batches):
            i = piece.schema.get_field_index("text")
            texts = pa.array([clean(t) for t in piece.column(i).to_pylist()], piece.schema.field(i).type)
            yield piece.set_column(i, piece.schema.field(i), texts)

    return docs.mapInArrow(rewrite, schema)
