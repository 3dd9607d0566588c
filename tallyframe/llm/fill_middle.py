"""Fill-in-middle transformation: a wavelet matrix over the characters' classes counts unit boundaries by ranks, and
bisection on those counts finds both cuts of every text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import map_batches, mask, table, text_bytes

#: Classes of a character, by itself and by the one before it; a text begins as if after a line feed.
INSIDE, RUN, OTHER, LINE_RUN, LINE_OTHER = range(5)
BITS = 3
#: The classes that start a unit: letter runs and single other characters, lines, or characters.
UNITS = {"token": (RUN, OTHER, LINE_RUN, LINE_OTHER), "line": (LINE_RUN, LINE_OTHER), "char": (INSIDE, RUN, OTHER, LINE_RUN, LINE_OTHER)}
MARKERS = ("<P>", "<S>", "<M>")
_LETTER = mask((65, 90), (97, 122))


class WaveletMatrix:
    """Ranks over a sequence of codes below 2^bits. Each level keeps one bit of every code, the highest first; the
    next level holds the codes with a 0 before those with a 1, in their order."""

    def __init__(self, codes: np.ndarray, bits: int = BITS):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (codes >> bit) & 1
            packed = np.packbits(ones.astype(np.uint8), bitorder="little")
            words = np.zeros(len(codes) // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
            self.levels.append((bit, words, before, len(codes) - int(before[-1])))
            codes = np.concatenate((codes[ones == 0], codes[ones == 1]))

    def rank(self, code: int, ends: np.ndarray) -> np.ndarray:
        """How often the code stands before each end."""
        first, ends = np.zeros(1, np.int64), ends.astype(np.int64)
        for bit, words, before, zeros in self.levels:
            of_first, of_ends = self._ones(words, before, first), self._ones(words, before, ends)
            first, ends = (zeros + of_first, zeros + of_ends) if code >> bit & 1 else (first - of_first, ends - of_ends)
        return ends - first

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, ends: np.ndarray) -> np.ndarray:
        at = ends >> 6
        below = (np.uint64(1) << (ends & 63).astype(np.uint64)) - np.uint64(1)
        return before[at] + np.bitwise_count(words[at] & below)


def character_classes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The class of each character of the texts, the byte each starts at (and the end of all), and each text's first character."""
    starts = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(starts, offsets)
    head = data[starts[:-1]]
    letter = _LETTER[head]
    fresh, after_letter = np.zeros(len(head), bool), np.zeros(len(head), bool)
    fresh[1:], after_letter[1:] = head[:-1] == 10, letter[:-1]
    begins = first[:-1][first[:-1] < first[1:]]
    fresh[begins], after_letter[begins] = True, False
    classes = np.where(letter, np.where(after_letter, INSIDE, RUN), OTHER).astype(np.uint8)
    return np.where(fresh, np.where(letter, LINE_RUN, LINE_OTHER), classes).astype(np.uint8), starts, first


def cut_places(matrix: WaveletMatrix, unit: str, begins: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each text (its first character and its end), where the first `counts` units end: the character that starts
    the next unit, or the text's end."""
    behind = _started(matrix, unit, begins) + counts
    low, high = begins.copy(), ends.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        reached = _started(matrix, unit, np.minimum(middle + 1, ends)) > behind
        high, low = np.where(open_ & reached, middle, high), np.where(open_ & ~reached, middle + 1, low)
    return low


def _started(matrix: WaveletMatrix, unit: str, ends: np.ndarray) -> np.ndarray:
    """Units that start before each end: the ranks of the classes that start one, added up."""
    return sum((matrix.rank(code, ends) for code in UNITS[unit]), np.zeros(len(ends), np.int64))


def _draws(seed: str) -> list[Column]:
    """Four numbers below 2^32 for each doc_id: the first groups of eight digits of the sha256 of `seed:doc_id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: str = "1", unit: str = "token", rate: int = 90, spm: int = 20, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n, form, prefix_chars, middle_chars, output; one row for each row read.

    A text is cut into n units (UNITS) and twice between units, at places drawn from its doc_id and the seed: after
    h1 % (n + 1) and h2 % (n + 1) units. Of a hundred, `rate` are turned, `spm` of a hundred of those to suffix, prefix, middle
    and the others to prefix, suffix, middle, each part behind its marker; the middle comes last. Texts that are
    empty or null, or hold a marker, and the texts not drawn stay plain: output is the text, the counts are null.

    prefix_chars and middle_chars count code points. Rows without an id draw as if it were empty; rows that share an id
    draw alike; other columns are ignored; an empty table gives an empty result. A batch holds a few megabytes
    of text, or one longer text, and about forty bytes for each of its bytes."""
    marks = [marker.encode() for marker in markers]
    seen = docs.select("doc_id", "text", *_draws(seed))

    def turn(batch: pa.RecordBatch) -> list:
        data, offsets = text_bytes(batch.column("text"))
        h1, h2, h3, h4 = (np.asarray(batch.column(f"h{k}")).astype(np.int64) for k in range(1, 5))
        classes, starts, first = character_classes(data, offsets)
        matrix = WaveletMatrix(classes)
        begins, ends = first[:-1], first[1:]
        n = _started(matrix, unit, ends) - _started(matrix, unit, begins)
        u, v = h1 % (n + 1), h2 % (n + 1)
        one, two = (cut_places(matrix, unit, begins, ends, cut(u, v)) for cut in (np.minimum, np.maximum))
        texts = data.tobytes()
        forms, prefixes, middles, outputs = [], [], [], []
        for d in range(len(n)):
            text = texts[offsets[d] : offsets[d + 1]]
            if not text or h3[d] % 100 >= rate or any(mark in text for mark in marks):
                form, output, prefix, middle = "plain", text, None, None
            else:
                a, b = starts[one[d]] - offsets[d], starts[two[d]] - offsets[d]
                parts = {"P": marks[0] + text[:a], "S": marks[1] + text[b:], "M": marks[2] + text[a:b]}
                form = "spm" if h4[d] % 100 < spm else "psm"
                output, prefix, middle = b"".join(parts[part.upper()] for part in form), one[d] - begins[d], two[d] - one[d]
            forms.append(form)
            prefixes.append(prefix)
            middles.append(middle)
            outputs.append(output)
        return [batch.column("doc_id"), n, forms, prefixes, middles, pa.array(outputs, pa.binary())]

    return map_batches(seen, turn, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: str | Column, form: str | Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text an output was made of, from output and form alone. Texts that are turned hold no marker, so the first
    marker of each kind is the one that was put there."""
    output, form = F.col(output) if isinstance(output, str) else output, F.col(form) if isinstance(form, str) else form

    def between(opening: str, closing: str | None) -> Column:
        start = F.locate(opening, output) + len(opening)
        return F.substring(output, start, F.length(output) if closing is None else F.locate(closing, output) - start)

    p, s, m = markers
    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    turned = fill_in_middle(table(spark, sf_dir, "documents"))
    return turned.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restore("output", "form"), 256).alias("restored_sha256")
    )


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units, sha256('1:' || coalesce(cast(doc_id AS varchar), '')) AS digest FROM documents),
h AS (SELECT doc_id, text, units, len(units) AS n, cast('0x' || digest[1:8] AS bigint) AS h1, cast('0x' || digest[9:16] AS bigint) AS h2,
  cast('0x' || digest[17:24] AS bigint) AS h3, cast('0x' || digest[25:32] AS bigint) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p
"""

QUERIES = {"op12_fill_middle": op12_fill_middle}
ORACLES = {"op12_fill_middle": OP12_SQL}
