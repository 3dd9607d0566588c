"""Language ID by word-first backoff: known words count with their log frequency in each language, unseen words
fall back to progressively shorter character n-grams."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import map_batches, prepare, settle, table

#: Letters, with the marks on them; numerals are none.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: Longest n-gram of a word with its edge marks; shorter ones follow down to single characters.
LONGEST = 5
#: The model is fitted on about this many labelled rows of each language, drawn by a hash of id and text, and holds all
#: their words and n-grams, however many languages there are.
FIT_ROWS = 500
#: Words that no language knows, of which a worker keeps the value.
KEPT_WORDS = 50_000
UNDETERMINED = "und"


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _grams(word: str, size: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[at : at + size] for at in range(len(marked) - size + 1)] if size > 1 else list(word)


def _counts(rows: DataFrame) -> DataFrame:
    """lang, size (0: whole word, else n-gram length), term, n over all rows; counts leave a task in parts of
    bounded size."""
    prepare(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def flush() -> pa.RecordBatch:
            terms: Counter = Counter()
            for (lang, word), n in words.items():
                terms[lang, 0, word] += n
                for size in range(1, LONGEST + 1):
                    for gram in _grams(word, size):
                        terms[lang, size, gram] += n
            words.clear()
            keys = list(terms)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()), pa.array(list(terms.values()), pa.int64())], ["lang", "size", "term", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for word, n in Counter(WORD.findall(text.lower())).items():
                    words[lang, word] += n
                if len(words) > 50_000:
                    yield flush()
        if words:
            yield flush()

    return rows.mapInArrow(run, "lang string, size int, term string, n long").groupBy("lang", "size", "term").agg(F.sum("n").alias("n"))


class LanguageModel:
    def __init__(self, rows: list) -> None:
        """rows: (lang, size, term, n, total of the language and size)."""
        self.langs = sorted({row[0] for row in rows})
        place = {lang: at for at, lang in enumerate(self.langs)}
        totals: dict[tuple[int, int], int] = {}
        counts: list[dict[str, dict[int, int]]] = [{} for _ in range(LONGEST + 1)]
        for lang, size, term, n, total in rows:
            counts[size].setdefault(term, {})[place[lang]] = n
            totals[place[lang], size] = total
        self.tables: list[dict[str, tuple[float, ...]]] = []
        same: dict[tuple[float, ...], tuple[float, ...]] = {}  # most terms are rare, and equal counts have equal values
        for size, terms in enumerate(counts):
            unseen = [math.log(0.5 / (totals.get((at, size), 0) + len(terms) + 1)) for at in range(len(self.langs))]
            values: dict[str, tuple[float, ...]] = {}
            for term, found in terms.items():
                entry = tuple(math.log((found[at] + 0.5) / (totals[at, size] + len(terms) + 1)) if at in found else unseen[at] for at in range(len(self.langs)))
                values[term] = same.setdefault(entry, entry)
            self.tables.append(values)
        self.unknown: dict[str, tuple[float, ...]] = {}

    def word(self, word: str) -> tuple[float, ...]:
        """Log frequency by language; of the longest known n-grams, averaged, for a word that no language knows."""
        found = self.tables[0].get(word)
        if found is not None:
            return found
        for size in range(LONGEST, 0, -1):
            known = [entry for gram in _grams(word, size) if (entry := self.tables[size].get(gram)) is not None]
            if known:
                return tuple(sum(column) / len(known) for column in zip(*known))
        return (0.0,) * len(self.langs)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The most likely language (the first by name of equals) and its share of likelihood per word."""
        names, scores = [], []
        known, unknown = self.tables[0], self.unknown
        if len(unknown) > KEPT_WORDS:
            unknown.clear()
        for text in texts:
            words = WORD.findall(text.lower()) if text else []
            if not words or not self.langs:
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            counted = Counter(words)
            total = [0.0] * len(self.langs)
            for word, n in counted.items():
                entry = known.get(word) or unknown.get(word)
                if entry is None:
                    entry = unknown[word] = self.word(word)
                for at, value in enumerate(entry):
                    total[at] += n * value
            best = max(range(len(total)), key=lambda at: (total[at], -at))
            weight = min(len(words), 20) / len(words)
            names.append(self.langs[best])
            scores.append(1.0 / sum(math.exp((value - total[best]) * weight) for value in total))
        return names, scores


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS):
    """A broadcast model from rows (doc_id, text, lang). Rows without text or lang are left out; of a language with more
    than fit_rows rows, about fit_rows are drawn by a hash of id and text. The words and n-grams of these rows, and nothing
    else, come to the driver; repeated rows count as often as they are there, very long texts whole. An empty table
    gives a model without languages."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "lang", "text")
    sizes = settle(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("size")))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) * F.col("size") < 1_000_000 * fit_rows
    counts = settle(_counts(rows.join(sizes, "lang").where(drawn).select("doc_id", "lang", "text")))
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    terms = counts.join(totals, ["lang", "size"])
    model = LanguageModel([tuple(row) for row in terms.select("lang", "size", "term", "n", "total").toLocalIterator()])
    return labelled.sparkSession.sparkContext.broadcast(model)


def predict(docs: DataFrame, model) -> DataFrame:
    """docs (doc_id, text, ...) -> the same columns with lang_pred and score, one row for each row, repeated ones too. Null texts
    and texts without a letter, and all texts if nothing was learned, give `und` and 0. Ties go to the first language by name.
    A text is read whole, however long; an empty table gives an empty result."""
    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"

    def run(batch: pa.RecordBatch) -> list:
        return [*(batch.column(f.name) for f in fields), *model.value.predict(batch.column("text").to_pylist())]

    return map_batches(docs.select(*(f"`{f.name}`" for f in fields)), run, schema)


def keep_known(docs: DataFrame, min_score: float = 0.3) -> DataFrame:
    """docs without rows of no determinable language: no letter, or a best language below min_score. Every row is judged for
    itself, so repeated rows stay or go together; an empty table stays empty."""
    model = fit(docs.where(~F.coalesce(held_out(F.col("doc_id")), F.lit(False))))
    return predict(docs, model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)).select(*docs.columns)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return predict(docs.select("doc_id", "text"), fit(docs.where(~out))).select("doc_id", out.alias("held_out"), "lang_pred", "score")


QUERIES = {"op10_language": op10_language}
ORACLES: dict[str, str] = {}
