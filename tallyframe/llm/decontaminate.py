"""Benchmark decontamination: a generalised suffix automaton of the normalised test items streams the words of
each text and tracks the longest match; stretches at least one window long are hits."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import ALNUM, LOWER, map_batches, numbered, set_aside, settle, table, text_bytes, word_hashes, word_spans

WINDOW = 10
#: Words of test items in one automaton; more items make more automata, one after the other.
BLOCK_WORDS = 400_000
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class ItemAutomaton:
    """Generalised suffix automaton over the word sequences of some items, with the windows that count."""

    def __init__(self, items: list[tuple[object, str]], window: int) -> None:
        texts = pa.array([text for _, text in items], pa.large_string())
        data, offsets = text_bytes(texts)
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets, ALNUM)
        hashes = word_hashes(data, starts, ends)
        self.words = np.unique(hashes)
        sequences = [np.searchsorted(self.words, hashes[a:b]).tolist() for a, b in zip(first[:-1], first[1:])]
        self.arcs: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.windows: dict[tuple, set] = defaultdict(set)
        pairs = set()
        for (item, _), words in zip(items, sequences):
            last = 0
            for word in words:
                last = self._extend(last, word)
            pairs.update(zip(words, words[1:]))
            size = min(window, len(words))
            for at in range(len(words) - size + 1 if size else 0):
                self.windows[tuple(words[at : at + size])].add(item)
        self.sizes = sorted({len(found) for found in self.windows})
        self.pairs = np.unique(np.array([a * len(self.words) + b for a, b in pairs], np.int64))

    def _extend(self, last: int, word: int) -> int:
        arcs, link, length = self.arcs, self.link, self.length
        if word in arcs[last]:
            target = arcs[last][word]
            return target if length[target] == length[last] + 1 else self._split(last, word, target)
        state = len(arcs)
        arcs.append({})
        length.append(length[last] + 1)
        link.append(0)
        while last >= 0 and word not in arcs[last]:
            arcs[last][word] = state
            last = link[last]
        if last >= 0:
            target = arcs[last][word]
            link[state] = target if length[target] == length[last] + 1 else self._split(last, word, target)
        return state

    def _split(self, last: int, word: int, target: int) -> int:
        arcs, link, length = self.arcs, self.link, self.length
        copy = len(arcs)
        arcs.append(dict(arcs[target]))
        length.append(length[last] + 1)
        link.append(link[target])
        link[target] = copy
        while last >= 0 and arcs[last].get(word) == target:
            arcs[last][word] = copy
            last = link[last]
        return copy

    def matches(self, words: list[int]):
        """The longest match that ends at each word."""
        state = length = 0
        for word in words:
            while state and word not in self.arcs[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.arcs[state]:
                state = self.arcs[state][word]
                length += 1
            yield length

    def stretches(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids of the batch, and the maximal stretches inside one text whose neighbouring words are arcs of
        the automaton; a match of two words or more lies in one of them."""
        if not len(self.words) or not len(hashes):
            return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[ids] == hashes
        if self.sizes[0] == 1:
            joined = known[:-1] & known[1:]
        else:
            joined = known[:-1] & known[1:]
            at = np.flatnonzero(joined)
            codes = ids[at].astype(np.int64) * len(self.words) + ids[at + 1]
            joined[at] = self.pairs[np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)] == codes
        inner = first[1:-1]
        joined[inner[(inner > 0) & (inner < len(hashes))] - 1] = False
        edges = np.diff(np.concatenate(([False], joined, [False])).astype(np.int8))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + 1
        if self.sizes[0] == 1:
            alone = np.flatnonzero(known & ~np.concatenate(([False], joined)) & ~np.concatenate((joined, [False])))
            starts, ends = np.concatenate((starts, alone)), np.concatenate((ends, alone + 1))
        long = ends - starts >= self.sizes[0]
        return ids, starts[long], ends[long]

    def hits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, dict[int, set]]:
        """Word starts, ends, words before each text, the words hit, and the items met by each text."""
        data, offsets = text_bytes(texts)
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets, ALNUM)
        hit, items = np.zeros(len(starts), bool), {}
        if self.windows:
            ids, begin, end = self.stretches(word_hashes(data, starts, ends), first)
            for a, b in zip(begin.tolist(), end.tolist()):
                words = ids[a:b].tolist()
                for at, length in enumerate(self.matches(words), 1):
                    for size in self.sizes:
                        if size > length:
                            break
                        if found := self.windows.get(tuple(words[at - size : at])):
                            hit[a + at - size : a + at] = True
                            items.setdefault(int(np.searchsorted(first, a, "right")) - 1, set()).update(found)
        return starts, ends, first, hit, items


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list:
    """Broadcast automata over all items; each holds about block_words words, so what is collected and broadcast
    at a time is bounded however many items there are. Null texts hold no window; items without an id have windows
    like all others, but no name to list."""
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    total = items.agg(F.sum(F.regexp_count("text", F.lit(WORD_PATTERN)))).first()[0] or 0
    blocks = -(-total // block_words)
    context = benchmark.sparkSession.sparkContext
    return [
        context.broadcast(ItemAutomaton([tuple(row) for row in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()], window))
        for block in range(blocks)
    ]


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs (doc_id, text, ...), benchmark (item_id, text, ...) -> doc_id, n_words, spans, items; one row for each row read.

    Words are runs outside 00-2F, 3A-60 and 7B-7F after lower-casing A-Z. A window is `window` consecutive words
    of an item, or a shorter item as a whole; spans are the maximal runs of words (from 0, end exclusive) inside
    any occurrence of a window, items the ids (as strings, sorted) of items with an occurring window; windows of items
    without an id make spans, but no entry there. Null and
    empty texts have no words and no hits, items of no words have no windows, empty tables give no hits or no
    rows, and other columns are ignored. With more than one automaton, what each finds is united by row."""
    blocks = automata(benchmark, window, block_words)
    if not blocks:
        words = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
        return docs.select("doc_id", words.alias("n_words"), F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"))
    if len(blocks) == 1:
        return _found(docs, "doc_id", blocks[0])
    rows = numbered(docs.select("doc_id", "text"))
    merged = _found_in_all(rows, blocks)
    return rows.select("_row", "doc_id").join(merged, "_row").drop("_row")


_FOUND = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def _found(rows: DataFrame, key: str, shared) -> DataFrame:
    """key, n_words, spans and items of each row by one automaton."""

    def find(batch: pa.RecordBatch) -> list:
        _, _, first, hit, items = shared.value.hits(batch.column("text"))
        spans = [_runs(hit[first[text] : first[text + 1]]) if text in items else [] for text in range(batch.num_rows)]
        return [batch.column(key), np.diff(first), spans, [sorted(str(item) for item in items.get(text, ()) if item is not None) for text in range(batch.num_rows)]]

    return map_batches(rows.select(key, "text"), find, f"{key} long, {_FOUND}")


def _found_in_all(rows: DataFrame, blocks: list) -> DataFrame:
    """_row, n_words, spans and items of each numbered row, united over all automata."""
    parts = _found(rows, "_row", blocks[0])
    for shared in blocks[1:]:
        parts = parts.unionByName(_found(rows, "_row", shared))
    merged = parts.groupBy("_row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    return map_batches(merged, lambda batch: [batch.column(0), batch.column(1), [_united(spans) for spans in batch.column(2).to_pylist()], batch.column(3)], f"_row long, {_FOUND}")


def _runs(hit: np.ndarray) -> list[dict]:
    edges = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
    return [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))]


def _united(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if out and span["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append(dict(span))
    return out


def remove_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_share: float = 0.5, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs with every hit run cut out of its text (n_chars follows, where there is such a column); rows of which
    more than max_share of the words are hit go. Cutting repeats until no window is left in the text. Columns and
    untouched rows stay as they are, whatever the columns' names."""
    blocks = automata(benchmark, window, block_words)
    docs, restored = set_aside(docs, "_row", "_round", "_text", "_words", "_cut")
    return restored(_remove_by_rows(docs, blocks, max_share) if len(blocks) > 1 else _remove(docs, blocks, max_share))


def _remove(docs: DataFrame, blocks: list, max_share: float) -> DataFrame:
    """remove_leaks with one automaton, or none."""
    columns = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", `_words` long, `_cut` long"
    out = docs.withColumn("_words", F.lit(None).cast("long")).withColumn("_cut", F.lit(0).cast("long"))
    for shared in blocks:

        def strip(batch: pa.RecordBatch, shared=shared) -> list:
            texts = batch.column("text")
            starts, ends, first, hit, items = shared.value.hits(texts)
            found = {c: batch.column(c) for c in (*columns, "_words", "_cut")}
            found["_words"] = [int(n) if w is None else w for w, n in zip(batch.column("_words").to_pylist(), np.diff(first))]
            if items:
                new, cut = texts.to_pylist(), batch.column("_cut").to_pylist()
                counts = batch.column("n_chars").to_pylist() if "n_chars" in columns else None
                for at in items:
                    new[at], taken = _cut_text(new[at], shared.value)
                    cut[at] += taken
                    if counts:
                        counts[at] = len(new[at])
                found |= {"text": new, "_cut": cut} | ({"n_chars": counts} if counts else {})
            return [found[c] for c in (*columns, "_words", "_cut")]

        out = map_batches(out, strip, schema)
    return out.where(F.coalesce(F.col("_cut") <= max_share * F.col("_words"), F.lit(True))).select(*columns)


def _remove_by_rows(docs: DataFrame, blocks: list, max_share: float) -> DataFrame:
    """remove_leaks with several automata: each round unites what all of them find in a row, then cuts once; rows that
    were cut are looked through again by all."""
    rows = numbered(docs)
    todo, rounds = rows.select("_row", "text"), []
    while True:

        def cut(batch: pa.RecordBatch) -> list:
            new = [_without(text, spans) for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())]
            taken = [sum(span["end"] - span["start"] for span in spans) for spans in batch.column("spans").to_pylist()]
            return [batch.column("_row"), new, batch.column("n_words"), taken]

        found = _found_in_all(todo, blocks).where("size(spans) > 0").select("_row", "n_words", "spans")
        todo = settle(map_batches(todo.select("_row", "text").join(found, "_row").select("_row", "text", "n_words", "spans"), cut, "_row long, text string, _words long, _cut long"))
        if todo.isEmpty():
            break
        rounds.append(todo.withColumn("_round", F.lit(len(rounds))))
    if not rounds:
        return rows.select(*docs.columns)
    cuts = rounds[0]
    for later in rounds[1:]:
        cuts = cuts.unionByName(later)
    last = cuts.groupBy("_row").agg(F.max_by("text", "_round").alias("_text"), F.min_by("_words", "_round").alias("_words"), F.sum("_cut").alias("_cut"))
    out = rows.join(last, "_row", "left").where(F.coalesce(F.col("_cut") <= max_share * F.col("_words"), F.lit(True)))
    new = {"text": F.coalesce("_text", "text"), "n_chars": F.when(F.col("_text").isNotNull(), F.length("_text")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return out.select(*(new[f.name].cast(f.dataType).alias(f.name) if f.name in new else F.col(f.name) for f in docs.schema.fields))


def _cut_text(text: str, automaton: ItemAutomaton) -> tuple[str, int]:
    taken = 0
    while True:
        _, _, _, hit, items = automaton.hits(pa.array([text], pa.large_string()))
        if not items:
            return text, taken
        taken += int(hit.sum())
        text = _without(text, _runs(hit))


def _without(text: str, runs: list[dict]) -> str:
    """text without the given runs of words."""
    raw = text.encode()
    data, offsets = text_bytes(pa.array([text], pa.large_string()))
    starts, ends, _ = word_spans(LOWER[data], offsets, ALNUM)
    kept, at = [], 0
    for run in runs:
        kept.append(raw[at : starts[run["start"]]])
        at = ends[run["end"] - 1]
    return b"".join([*kept, raw[at:]]).decode()


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


_SQL_WORDS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, coalesce({_SQL_WORDS}, []) AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda k: array_to_string(w[k:k + least(len(w), 10) - 1], ' '))) AS g FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS g FROM d, sizes WHERE len(w) >= n),
m AS (SELECT dw.doc_id, k, dw.n, item_id FROM dw JOIN iw ON iw.n = dw.n AND iw.g = dw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR)) FILTER (item_id IS NOT NULL)) AS items FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""

QUERIES = {"op4_decontaminate": op4_decontaminate}
ORACLES = {"op4_decontaminate": OP4_SQL}
