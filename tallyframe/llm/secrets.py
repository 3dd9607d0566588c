"""Secret scans: known shapes, and a token-efficiency test that finds random strings by their low number of
characters for each token of a tiktoken vocabulary."""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import map_batches, table

#: Fixed shapes, in the order in which they are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
NAMES = ("passw", "secret", "token", "api")

#: The efficiency test: strings of at least this many characters that hold a letter. Without a digit the separators are
#: left out of the ratio, or names of short words in capitals would pass for random.
SHORTEST = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PIECE = re.compile(r"[A-Za-z0-9]+")
MAX_CHARS_PER_TOKEN = 2.0
DIGEST_SIZES = frozenset({32, 40, 56, 64, 96, 128})
HEX_ONLY = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
UUID_WITHIN = re.compile(rf"(?<![0-9A-Za-z]){UUID.pattern}(?![0-9A-Za-z])")
LETTER, DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")

_LOADED: dict[str, object] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def vocabulary(path: str):
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
        _LOADED[path] = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def is_known(string: str) -> bool:
    """A digest by its length in hex, or an identifier."""
    return (HEX_ONLY.fullmatch(string) is not None and len(string) in DIGEST_SIZES) or UUID.fullmatch(string) is not None


def random_spans(text: str, taken: list[tuple[int, int, str]], encoding, limit: float) -> list[tuple[int, int, str]]:
    """Candidates with few characters for each token, outside the spans already taken: the whole run of characters,
    or else its pieces between separators and the windows over their tokens, overlapping ones united."""
    found = []
    for m in CANDIDATE.finditer(text):
        string, at = m.group(), m.start()
        if LETTER.search(string) is None or is_known(string):
            continue
        if DIGIT.search(string) and len(string) < limit * len(encoding.encode_ordinary(string)):
            spans = [(0, len(string))]
        else:
            spans = dense_spans(string, encoding, limit)
        found += [(at + a, at + b, "random") for a, b in spans if not any(x <= at + a and at + b <= y for x, y, _ in taken)]
    return found


def dense_spans(string: str, encoding, limit: float) -> list[tuple[int, int]]:
    """Where pieces between separators, or the shortest windows of SHORTEST characters from each token on, hold few
    characters for each token. Separators count neither way there; windows end at digests and identifiers."""
    known = [m.span() for m in UUID_WITHIN.finditer(string)]
    spans, stretches = [], [[]]
    for m in PIECE.finditer(string):
        a, b = m.span()
        if is_known(m.group()) or any(x <= a < y for x, y in known):
            stretches.append([])
            continue
        tokens = token_lengths(m.group(), encoding)
        if b - a >= SHORTEST and b - a < limit * len(tokens) and LETTER.search(m.group()):
            spans.append((a, b))
        for size in tokens:
            stretches[-1].append((a, a + size))
            a += size
    for tokens in stretches:
        end = size = 0
        for first, (a, b) in enumerate(tokens):
            while end < len(tokens) and (end == first or tokens[end - 1][1] - a < SHORTEST):
                size += tokens[end][1] - tokens[end][0]
                end += 1
            last = tokens[end - 1][1]
            if last - a < SHORTEST:
                break
            if size < limit * (end - first) and LETTER.search(string, a, last):
                spans.append((a, last))
            size -= b - a
    united: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if united and a <= united[-1][1]:
            united[-1] = (united[-1][0], max(b, united[-1][1]))
        else:
            united.append((a, b))
    return united


def token_lengths(string: str, encoding) -> list[int]:
    return [len(encoding.decode_single_token_bytes(token)) for token in encoding.encode_ordinary(string)]


def find_secrets(docs: DataFrame, path: str | None = None, limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, spans (kind, start, end; code points, end exclusive), one row for each
    row read, ordered by start and then by kind as listed. Kinds assign, access and hex are fixed shapes; random
    is what the efficiency test adds (runs, their pieces and windows), except digests, identifiers and what a shape already covers. Null and empty
    texts have no spans; other columns are ignored; an empty table gives an empty result."""
    path = path or default_vocabulary()

    def run(batch: pa.RecordBatch) -> list:
        encoding, rows = vocabulary(path), []
        for text in batch.column("text").to_pylist():
            base = base_spans(text) if text else []
            spans = base + (random_spans(text, base, encoding, limit) if text else [])
            rows.append([{"kind": kind, "start": a, "end": b} for a, b, kind in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))])
        return [batch.column("doc_id"), rows]

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


QUERIES = {"op7_secret_scan": op7_secret_scan}
ORACLES: dict[str, str] = {}
