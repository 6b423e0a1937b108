"""Secret scans: fixed patterns, plus a randomness test battery for what no pattern names.

Base spans are those of three patterns (assigned credentials, access keys, long hex runs). The
battery looks at every other run of encoded-looking characters:

1. The encoding is inferred from the run's characters (hex, base32, base64 or its URL form).
2. Against the hypothesis "uniformly random in that encoding" three p-values are taken: chi-squared
   over the alphabet, the runs test about the alphabet's middle, and the lag-1 serial correlation.
   Fisher's method combines them.
3. Text-like runs have tiny p-values, random ones uniform p-values. Per encoding and length class
   (a power of two), the share of random runs is estimated from the upper half of the p-values
   of the whole table, and the smallest cut-off is taken at which the expected share of
   non-random runs above it stays within ``rate``: false-discovery control that knows length.
   Every distinct run is one test, however many rows repeat it; the cut then applies to all rows. A
   class with fewer than ``LEAST_RUNS`` distinct runs, or without any in the upper half, is judged with
   its neighbouring length classes, and if these are too few by the fixed bound ``SINGLE_P`` per run.

Defined results: null and empty texts have no spans; texts are scanned whole; repeated rows and
repeated keys stay rows, as nothing is joined by key; a class judged on enough runs in which
no cut keeps the share adds nothing.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, read_table

# The contract's patterns and least lengths.
ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
# --- end of fixed values

KINDS = ("assign", "access", "hex", "random")
RATE = 0.05
LEAST_RANDOM = 16
BINS = 200
LEAST_RUNS = 40
SINGLE_P = 0.01
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_ALPHABETS = {
    "hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
_PLACES = {name: {c: i for i, c in enumerate(letters)} for name, letters in _ALPHABETS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, per kind leftmost and non-overlapping."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]  # maximal runs: the same as filtering HEX
    return sorted(found)


def encoding_of(run: str) -> str | None:
    """The narrowest encoding that fits: it needs digits beside letters, and mixed case from 62 letters up."""
    body = run.rstrip("=")
    digit = any(c.isdigit() for c in body)
    upper, lower = any("A" <= c <= "Z" for c in body), any("a" <= c <= "z" for c in body)
    if not digit or not (upper or lower):
        return None
    if not upper or not lower:
        if all(c in _PLACES["hex"] for c in body.lower()):
            return "hex"
        if upper and all(c in _PLACES["base32"] for c in body):
            return "base32"
        return None
    for name in ("base62", "base64", "base64url"):
        if all(c in _PLACES[name] for c in body):
            return name
    return None


def _normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_squared_tail(x: float, degrees: int) -> float:
    """Upper tail by the cube-root normal approximation."""
    z = ((x / degrees) ** (1 / 3) - (1 - 2 / (9 * degrees))) / math.sqrt(2 / (9 * degrees))
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(run: str, encoding: str) -> float:
    """Combined p-value of the battery: small for runs that are not uniformly random."""
    places = _PLACES[encoding]
    body = run.rstrip("=")
    if encoding == "hex":
        body = body.lower()
    v = np.array([places[c] for c in body], dtype=float)
    n, k = len(v), len(places)
    counts = np.bincount(v.astype(int), minlength=k)
    p_uniform = _chi_squared_tail(float(((counts - n / k) ** 2).sum() / (n / k)), k - 1)
    high = v >= k / 2
    n1, n0 = int(high.sum()), int((~high).sum())
    if n1 and n0:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * n1 * n0 / n
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_runs = _normal_two_sided((runs - mean) / spread)
    else:
        p_runs = 2.0 ** (1 - n)
    # Under uniformity the mean and variance are known, so no fitting from few letters.
    centred = (v - (k - 1) / 2) / math.sqrt((k * k - 1) / 12)
    p_serial = _normal_two_sided(float((centred[1:] * centred[:-1]).sum()) / math.sqrt(n - 1))
    logs = -2 * sum(math.log(max(p, 1e-300)) for p in (p_uniform, p_runs, p_serial))
    half = logs / 2  # chi-squared with six degrees has a closed tail
    return math.exp(-half) * (1 + half + half * half / 2)


def length_class(n: int) -> int:
    """Runs of similar length are judged together: the power of two below their length."""
    return int(math.log2(n))


def _digest(run: str) -> int:
    """Signed 64 bits that stand for a run."""
    return int.from_bytes(hashlib.blake2b(run.encode(), digest_size=8).digest(), "little", signed=True)


def candidates(text: str) -> list[tuple[int, int, str, int, float, int]]:
    """(start, end, encoding, length class, p, digest of the run) of runs outside base spans."""
    runs = [m.span() for m in _RUN.finditer(text)]
    if not runs:
        return []
    taken = [(s, e) for s, _, e in base_spans(text)]
    out = []
    for start, end in runs:
        if any(s < end and start < e for s, e in taken):
            continue
        encoding = encoding_of(text[start:end])
        if encoding and len(text[start:end].rstrip("=")) >= LEAST_RANDOM:
            out.append((start, end, encoding, length_class(end - start), randomness(text[start:end], encoding), _digest(text[start:end])))
    return out


_FOUND = "n_assign long, n_access long, n_hex long, base string, tried array<struct<s:int,e:int,enc:string,cls:int,p:double,run:long>>"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over the whole texts: base spans, and the battery's runs with their p-values."""

    @F.pandas_udf(_FOUND)
    def look(batch: pd.Series) -> pd.DataFrame:
        rows = []
        for value in batch:
            value = value or ""
            spans = base_spans(value)
            kinds = [k for _, k, _ in spans]
            rows.append((
                kinds.count(0), kinds.count(1), kinds.count(2),
                ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans), candidates(value),
            ))
        return pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "tried"])

    return docs.select(F.col(key).alias("key"), look(F.col(text)).alias("f")).select("key", "f.*")


def cut_offs(scanned: DataFrame, rate: float = RATE) -> dict[tuple[str, int], float]:
    """Smallest p-value bin edge per (encoding, length class) that keeps the false-discovery share.

    The driver sees one number per class and bin: at most encodings x 32 classes x ``BINS``.
    """
    runs = scanned.select(F.explode("tried").alias("t")).groupBy("t.enc", "t.cls", "t.run").agg(F.first("t.p").alias("p"))  # equal runs have equal p
    tried = runs.select("enc", "cls", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).alias("bin"))
    tables: dict[tuple[str, int], np.ndarray] = {}
    for row in tried.groupBy("enc", "cls", "bin").count().collect():
        tables.setdefault((row["enc"], row["cls"]), np.zeros(BINS))[row["bin"]] = row["count"]
    return {name: cut for name in tables if (cut := class_cut(tables, name, rate)) is not None}


def class_cut(tables: dict[tuple[str, int], np.ndarray], name: tuple[str, int], rate: float = RATE) -> float | None:
    """Cut-off of one class: from its own runs, else with its neighbours', else the fixed bound."""
    encoding, cls = name
    enough = lambda c: c.sum() >= LEAST_RUNS and c[BINS // 2 :].sum() > 0
    if enough(tables[name]):
        return lowest_cut(tables[name], rate)
    near = [tables[encoding, c] for c in (cls - 1, cls, cls + 1) if (encoding, c) in tables]
    pooled = np.sum(near, axis=0)
    return lowest_cut(pooled, rate) if enough(pooled) else SINGLE_P


def lowest_cut(counts: np.ndarray, rate: float = RATE) -> float | None:
    """From p-value counts: random runs are uniform, so the upper half shows how many there are."""
    per_bin = 2 * counts[BINS // 2 :].sum() / BINS
    if per_bin == 0:
        return None
    above = np.cumsum(counts[::-1])[::-1]
    expected = per_bin * np.arange(BINS, 0, -1)
    false_share = 1 - np.minimum(1, expected / np.maximum(above, 1))
    fits = np.flatnonzero(false_share <= rate)
    return float(fits[0] / BINS) if len(fits) else None


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """key, n_assign, n_access, n_hex, base_sha256 and spans of every row of ``docs``."""
    scanned = cut_lineage(scan(docs, key, text))
    kept = cut_offs(scanned, rate)

    def passes(t: Column) -> Column:
        out = F.lit(False)
        for (encoding, cls), cut in kept.items():
            out = out | ((t["enc"] == encoding) & (t["cls"] == cls) & (t["p"] >= cut))
        return out

    part = lambda x, i: F.split(x, ":")[i]
    number = lambda x: (
        F.when(part(x, 0) == KINDS[0], 0).when(part(x, 0) == KINDS[1], 1).when(part(x, 0) == KINDS[2], 2).otherwise(3)
    )
    base = F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.split("base", ","))
    added = F.transform(
        F.filter("tried", passes), lambda t: F.concat_ws(":", F.lit(KINDS[3]), t["s"].cast("string"), t["e"].cast("string"))
    )
    ordered = F.array_sort(
        F.transform(F.concat(base, added), lambda x: F.struct(part(x, 1).cast("int").alias("s"), number(x).alias("k"), x.alias("x")))
    )
    return scanned.select(
        F.col("key").alias(key), "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"),
        F.array_join(F.transform(ordered, lambda o: o["x"]), ",").alias("spans"),
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = RATE, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; overlapping spans become one.

    The cut-offs come from one narrow pass over all rows; the second pass finds and replaces
    inside the row, so no text is shuffled. Null texts stay null.
    """
    kept = cut_offs(cut_lineage(scan(docs, key, text).select("tried")), rate)

    @F.pandas_udf("string")
    def clean(batch: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else replace_spans(t, kept, mark) for t in batch], dtype=object)

    return docs.withColumn(text, clean(F.col(text)))


def replace_spans(text: str, kept: dict[tuple[str, int], float], mark: str) -> str:
    """One text without its secrets."""
    spans = [(s, e) for s, _, e in base_spans(text)]
    spans += [(s, e) for s, e, enc, cls, p, _ in candidates(text) if p >= kept.get((enc, cls), 2.0)]
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return find_secrets(read_table(spark, sf_dir, "documents"))
