"""Secret scans: three plain patterns, and random strings found by their token
efficiency.

Text that a tokenizer's vocabulary was made for takes few tokens; a random
string takes many.  A long run of key characters with less than
``min_chars_per_token`` characters to the token is reported, unless it is a
known digest (hex of a usual digest length, a UUID) or an identifier (letters
only, digits only, or words joined by ``_ - / .``).
"""

from __future__ import annotations

import base64
import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.llm.common import text_batches

#: Fixed values of the contract: the kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_SPAN = "array<struct<kind:string,start:int,end:int>>"

#: Candidates of the method, and what is left out.
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_DIGEST = re.compile(r"(?:0x)?(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
_IDENT = re.compile(r"[\d_=+/-]+|(?:[A-Za-z]+|\d{1,4})(?:[_=+/-]+(?:[A-Za-z]+|\d{1,4}))*[_=+/-]*")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def load_encoding(path: str, special: dict[str, int] | None = None):
    """A tiktoken encoding from a file of ranks."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=special or {})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the plain patterns; leftmost, not overlapping within a kind."""
    out = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def random_spans(text: str, encode, base: list[tuple[int, int, int]], min_chars_per_token: float) -> list[tuple[int, int, int]]:
    out, merged = [], []
    for s, _, e in sorted(base):
        if merged and s < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    for m in _RUN.finditer(text):
        run = m.group()
        if _DIGEST.fullmatch(run) or _UUID.search(run) or _IDENT.fullmatch(run):
            continue
        i = bisect.bisect_left(merged, [m.end()])  # spans before i begin before the run ends
        if i and merged[i - 1][1] > m.start():
            continue
        if len(run) < min_chars_per_token * len(encode(run)):
            out.append((m.start(), 3, m.end()))
    return out


def scan_text(text: str, encode, min_chars_per_token: float = 2.0) -> tuple[list, list]:
    base = base_spans(text)
    return base, random_spans(text, encode, base, min_chars_per_token)


def scan(docs: DataFrame, *, text: str = "text", out: str = "secrets", vocabulary: str | None = None,
         min_chars_per_token: float = 2.0) -> DataFrame:
    """``docs`` with an array column ``out`` of the spans found in the whole
    text: kind, start and end in code points, end exclusive, by start and then
    kind as listed in ``KINDS``.  A column of that name is replaced.  Null and
    empty texts have no span.  ``vocabulary`` is a tiktoken rank file that
    every executor can read by this path.
    """
    text_batches(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    keep = [c for c in docs.columns if c != out]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*src.schema.fields, T.StructField(out, T._parse_datatype_string(_SPAN))])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        encode = load_encoding(path).encode_ordinary
        for b in batches:
            found = []
            for x in b.column(keep.index(text)):
                base, more = scan_text(x.as_py() or "", encode, min_chars_per_token)
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(base + more)])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, span)], names=[*keep, out])

    return src.mapInArrow(run, schema)


def redact(docs: DataFrame, *, text: str = "text", mark: str = "[SECRET]", **kw) -> DataFrame:
    """``docs`` with every span found replaced by ``mark`` in the text;
    overlapping spans are one.  ``n_chars``, where there is one, follows."""
    cols = docs.columns
    found = scan(docs, text=text, out="__spans", **kw)

    def run(batches):
        for b in batches:
            i = b.schema.names.index(text)
            texts, changed = [], []
            for x, spans in zip(b.column(i).to_pylist(), b.column("__spans").to_pylist(), strict=True):
                if spans:
                    parts, at = [], 0
                    for s in spans:
                        if s["start"] >= at:
                            parts += [x[at:s["start"]], mark]
                        at = max(at, s["end"])
                    x = "".join([*parts, x[at:]])
                texts.append(x)
                changed.append(bool(spans))
            arrays = []
            for name in cols:
                a = b.column(name)
                if name == text:
                    a = pa.array(texts, b.column(i).type)
                elif name == "n_chars":
                    a = pa.array([len(t) if c else n for t, c, n in zip(texts, changed, a.to_pylist(), strict=True)], a.type)
                arrays.append(a)
            yield pa.RecordBatch.from_arrays(arrays, names=cols)

    return found.mapInArrow(run, docs.schema)
