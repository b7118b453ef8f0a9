"""Secret spans: fixed rules, plus sliding-window Shannon entropy over candidate strings."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from math import log2

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import bounded

#: Rules of the contract (fixed values); spans at one place are listed in this order.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

#: Character classes: the alphabet of candidate strings, and the bits a window must reach.
CLASSES = ((re.compile(r"[0-9A-Fa-f]{20,}"), 3.0), (re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 3.8))
WINDOW = 20
#: Whole candidates and stretches that are known to be harmless (no window may touch the latter), and what stands before a
#: published digest.
ALLOWED = re.compile(r"^[0-9-]+$|^[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}$", re.IGNORECASE)
FILLER = re.compile(r"example|sample|dummy|placeholder|changeme|x{6,}|0{8,}|0123456789|abcdefghij", re.IGNORECASE)
#: A part between separators, as paths and names with dashes have them: a word, with a few digits behind it, or a number.
PLAIN_PART = re.compile(r"(?:(?<=[/_+=-])|^)(?:[A-Za-z]?[a-z]{2,}|[A-Z]{3,}|(?=\d))\d{0,4}(?=[/_+=-]|$)")
ALLOWED_BEFORE = re.compile(r"(?:sha(?:1|256|384|512)|md5|integrity|checksum|commit|etag)[\"']?\s*[:=-]?\s*[\"']?(?:sha\d+-)?$", re.IGNORECASE)
#: c * log2(c) for every count a window can hold, and one more for the step between two.
WEIGHT = [0.0, *[c * log2(c) for c in range(1, WINDOW + 2)]]
REDACTED = "[SECRET]"


def entropy_runs(s: str, least: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Joined stretches of ``s`` whose windows reach ``least`` bits; each step changes two counts only.

    A window also has to hold a letter and a digit, which leaves words and plain numbers alone.
    """
    if len(s) < window:
        return []
    count: dict[str, int] = {}
    total, digits, letters, runs = 0.0, 0, 0, []
    bits_of_window = window * log2(window)
    for i, new in enumerate(s):
        c = count.get(new, 0)
        total += WEIGHT[c + 1] - WEIGHT[c]
        count[new] = c + 1
        digits += "0" <= new <= "9"
        letters += new.isalpha()
        if i >= window:
            old = s[i - window]
            c = count[old]
            total += WEIGHT[c - 1] - WEIGHT[c]
            count[old] = c - 1
            digits -= "0" <= old <= "9"
            letters -= old.isalpha()
        if i >= window - 1 and digits and letters and (bits_of_window - total) / window >= least:
            start = i - window + 1
            if runs and start <= runs[-1][1]:
                runs[-1] = (runs[-1][0], i + 1)
            else:
                runs.append((start, i + 1))
    return runs


def open_stretches(s: str) -> Iterator[tuple[int, int]]:
    """What is left of a candidate without its harmless stretches and its plain parts."""
    at = 0
    for a, b in sorted(m.span() for p in (FILLER, PLAIN_PART) for m in p.finditer(s) if m.end() - m.start() > 2):
        if a > at:
            yield at, a
        at = max(at, b)
    yield at, len(s)


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of all spans, in listed order."""
    if not text:
        return []
    out: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = sorted(out)
    more: set[tuple[int, int]] = set()
    for alphabet, least in CLASSES:
        for m in alphabet.finditer(text):
            s = m[0]
            if s.isalpha() or s.isdigit() or ALLOWED.search(s) or ALLOWED_BEFORE.search(text[max(0, m.start() - 40) : m.start()]):
                continue
            for at, end in open_stretches(s):
                more.update((m.start() + at + a, m.start() + at + b) for a, b in entropy_runs(s[at:end], least))
    # ``reach`` is the furthest end of the spans that start no later.
    at, reach = 0, -1
    for a, b in sorted(more, key=lambda x: (x[0], -x[1])):
        while at < len(base) and base[at][0] <= a:
            reach = max(reach, base[at][2])
            at += 1
        if b > reach:
            out.append((a, 3, b))
            reach = b
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256 and spans.

    Offsets are code points, end exclusive. The rules' spans always stay; entropy spans are added unless they lie inside another
    span or on the allow list. Null text counts as empty (no spans, the digest of the empty string); repeated rows stay; an
    empty table gives no rows; other columns are not looked at. One pass without a shuffle.
    """

    @F.pandas_udf("n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in texts:
                spans = find_spans(t)
                base = [s for s in spans if s[1] < 3]
                n = [sum(s[1] == k for s in spans) for k in range(4)]
                rows.append((*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"])

    found = bounded(docs).select(F.col(id_col).alias("doc_id"), scan(F.col(text_col)).alias("s"))
    return found.select("doc_id", "s.*")


def redact(text: str | None) -> str | None:
    """The text with every span, or stretch of overlapping spans, replaced by a mark."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        start, _, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], REDACTED]
        at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with the secrets in ``text_col`` replaced; null texts stay null, empty ones empty, and repeated
    rows repeat; an empty table gives no rows."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(redact, na_action="ignore")

    return bounded(docs).withColumn(text_col, clean(F.col(text_col)))
