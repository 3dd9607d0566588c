"""BPE encoding and decoding by the tokens that may follow each other, decided from the merges as words need them.

The states of the tokenization automaton are the tokens last emitted, its arcs the next ones. It is not compiled
beforehand: a full arc table has an entry for every pair of tokens that may touch. An arc is decided by a test on the merges of
the two tokens' touching edges the first time that a word asks for it, and the decision is kept by pair. A word is encoded by a
dynamic program over the last token of each of its prefixes; exactly one path spells canonical BPE.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm.common import map_batches, table

WORD_END = "</w>"
#: Contractions, letter runs, single digits, runs of other signs. Letters follow the regex module's Unicode tables,
#: which may know characters that are newer than the tokenizers library's.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Encoded words that one worker keeps.
KEPT_WORDS = 800_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(byte) if byte in plain else chr(next(rest)) for byte in range(256)]


class MergeAutomaton:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {token: label for label, token in (self.ids | self.special).items()}
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in spec["model"]["merges"]]
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            a, b, token = self.ids[left], self.ids[right], self.ids[left + right]
            self.merged[a, b] = (rank, token)
            self.parts.setdefault(token, (rank, a, b))
        self.longest = max(len(label.removesuffix(WORD_END)) for label in self.ids)
        self.arcs: dict[tuple[int, int], bool] = {}
        self.reached: dict[int, bool] = {}
        self.letters = dict(enumerate(byte_letters()))
        reached = {label: token for label, token in self.ids.items() if self.token_reached(token)}
        self.inner = {label: token for label, token in reached.items() if not label.endswith(WORD_END)}
        self.final = {label.removesuffix(WORD_END): token for label, token in reached.items() if label.endswith(WORD_END)}
        self.marks = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def _applied(self, left: int, right: int) -> bool:
        """Undo the later of the two tokens' last merges, step by step, down to the bare edges: a merge of two
        edges that comes before both sides are whole would have joined them."""
        bound = len(self.merged)
        while True:
            joined = self.merged.get((left, right))
            if joined is not None and joined[0] < bound:
                return False
            at_left, at_right = self.parts.get(left), self.parts.get(right)
            if at_left is None and at_right is None:
                return True
            if at_right is None or (at_left is not None and at_left[0] > at_right[0]):
                bound, left = at_left[0], at_left[2]
            else:
                bound, right = at_right[0] + 1, at_right[1]

    def token_reached(self, token: int) -> bool:
        """Whether the token's own letters lead to it: some vocabulary entries are never produced."""
        found = self.reached.get(token)
        if found is None:
            parts = self.parts.get(token)
            found = self.reached[token] = parts is None or (
                self.token_reached(parts[1]) and self.token_reached(parts[2]) and self._first_joined(parts)
            )
        return found

    def _first_joined(self, parts: tuple[int, int, int]) -> bool:
        rank, left, right = parts
        bound = rank
        while True:
            at_left, at_right = self.parts.get(left), self.parts.get(right)
            if at_left is None and at_right is None:
                return True
            if at_right is None or (at_left is not None and at_left[0] > at_right[0]):
                bound, left = at_left[0], at_left[2]
            else:
                bound, right = at_right[0] + 1, at_right[1]
            joined = self.merged.get((left, right))
            if joined is not None and joined[0] < bound:
                return False

    def encode_word(self, word: str) -> list[int]:
        """The tokens of one pre-split word: its only path. `ending[i]` is the last arc of the path that spells
        the first i letters; the whole word's last letter carries the word end."""
        letters = word.encode().decode("latin-1").translate(self.letters)
        size, ids, arcs, longest = len(letters), self.inner, self.arcs, self.longest
        ending, spelled = [-1] * (size + 1), [0] * (size + 1)
        for end in range(1, size + 1):
            if end == size:
                ids = self.final
            for start in range(end - longest if end > longest else 0, end):
                token = ids.get(letters[start:end])
                if token is None:
                    continue
                if start:
                    allowed = arcs.get((ending[start], token))
                    if allowed is None:
                        allowed = arcs[ending[start], token] = self._applied(ending[start], token)
                    if not allowed:
                        continue
                ending[end], spelled[end] = token, start
                break
        out, at = [], size
        while at:
            out.append(ending[at])
            at = spelled[at]
        return out[::-1]

    def words(self, text: str):
        """Pre-split words in order; a special token's text is one."""
        at = 0
        for mark in self.marks.finditer(text) if self.marks and "<|" in text else ():
            yield from self._plain(text[at : mark.start()])
            yield mark.group()
            at = mark.end()
        yield from self._plain(text[at:] if at else text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        return PIECES.findall(text.lower() if "Σ" not in text else "".join(c.lower() for c in text))

    def decode(self, ids: list[int]) -> str:
        """Arc labels in order, as the vocabulary writes them."""
        return " ".join(self.labels[token] for token in ids)

    def readable(self, ids: list[int]) -> str:
        """Arc labels as text: byte letters become bytes again, word ends become spaces."""
        back = {letter: byte for byte, letter in self.letters.items()}
        out = b""
        for token in ids:
            label = self.labels[token]
            if label in self.special:
                out += label.encode() + b" "
            else:
                out += bytes(back[letter] for letter in label.removesuffix(WORD_END)) + (b" " if label.endswith(WORD_END) else b"")
        return out.decode("utf-8", "replace").removesuffix(" ")


class _Words(dict):
    """Tokens as bytes of the words met so far."""

    def __init__(self, automaton: MergeAutomaton) -> None:
        super().__init__()
        self.automaton = automaton
        self.written = {token: label.encode() for token, label in automaton.labels.items()}

    def __missing__(self, word: str) -> bytes:
        special = self.automaton.special.get(word)
        ids = [special] if special is not None else self.automaton.encode_word(word)
        self[word] = found = struct.pack(f"<{len(ids)}I", *ids)
        return found


_LOADED: dict[str, _Words] = {}


def loaded(path: str) -> _Words:
    if path not in _LOADED:
        _LOADED[path] = _Words(MergeAutomaton(path))
    words = _LOADED[path]
    if len(words) > KEPT_WORDS:
        words.clear()
    return words


def encode_text(text: str, path: str) -> tuple[bytes, bytes]:
    """Ids as little-endian 32-bit integers, and the decoded text in UTF-8."""
    words = loaded(path)
    ids = b"".join(map(words.__getitem__, words.automaton.words(text)))
    return ids, b" ".join(map(words.written.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs -> the same columns and `tokens array<int>`, the ids of text; null and empty texts have none. An
    existing column of that name is replaced. Rows keep their number and order; an empty table stays empty."""
    path = path or default_vocabulary()
    fields = [f for f in docs.schema.fields if f.name != "tokens"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", tokens array<int>"

    def run(batch: pa.RecordBatch) -> list:
        parts = [encode_text(text or "", path)[0] for text in batch.column("text").to_pylist()]
        ends = np.cumsum([0, *(len(part) // 4 for part in parts)], dtype=np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))
        return [*(batch.column(f.name) for f in fields), tokens]

    return map_batches(docs.select(*(f"`{f.name}`" for f in fields)), run, schema)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """Rows with `tokens` -> the same columns, `decoded` (labels joined by spaces) and `readable` (text again:
    lower case, one space between pieces). Null and empty lists give empty texts."""
    path = path or default_vocabulary()
    fields = [f for f in tokens.schema.fields if f.name not in ("decoded", "readable")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", decoded string, readable string"

    def run(batch: pa.RecordBatch) -> list:
        automaton = loaded(path).automaton
        lists = [ids or [] for ids in batch.column("tokens").to_pylist()]
        return [*(batch.column(f.name) for f in fields), [automaton.decode(ids) for ids in lists], [automaton.readable(ids) for ids in lists]]

    return map_batches(tokens.select(*(f"`{f.name}`" for f in fields)), run, schema)


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_tokens, ids_sha256, decoded_sha256; one row for each row read, null
    counts as empty."""
    path = path or default_vocabulary()

    def run(batch: pa.RecordBatch) -> list:
        rows = [encode_text(text or "", path) for text in batch.column("text").to_pylist()]
        digest = lambda part: [hashlib.sha256(row[part]).hexdigest() for row in rows]
        return [batch.column("doc_id"), [len(ids) // 4 for ids, _ in rows], digest(0), digest(1)]

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


QUERIES = {"op9_bpe": op9_bpe}
ORACLES: dict[str, str] = {}
