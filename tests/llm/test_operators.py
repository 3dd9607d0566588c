"""Corpus operators against plain Python, on the odd cases and on empty tables."""

import brute
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import bpe, decontaminate, exact_dedup, language, license_scan, near_dedup, pii, preference, secrets, suffix_dedup


def by_id(df, *columns):
    return {row.doc_id: tuple(row[c] for c in columns) for row in df.collect()}


def test_license_places(docs, rows_):
    got = by_id(license_scan.scan_licenses(docs), "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == brute.licenses(rows_)


def test_license_notices_and_scores(spark):
    texts = [(1, "x " * 70 + "Released under the MIT License."), (2, "under released the license mit"), (3, "released under license"), (4, "permission is granted free of charge to any person obtaining a copy of this software and documentation")]
    got = by_id(license_scan.scan_licenses(spark.createDataFrame(texts, "doc_id long, text string")), "labels", "score")
    assert got[1] == ("mit", 1.0) and got[2] == ("mit", 1.0) and got[3] == ("", 0.0)
    assert got[4][0] == "mit" and 0.8 <= got[4][1] < 1


def test_license_repeated_rows_stay_apart(spark):
    df = spark.createDataFrame([(1, "cc by"), (1, "cc by"), (None, "cc by cc by")], "doc_id long, text string")
    assert sorted(row.n_base for row in license_scan.scan_licenses(df).collect()) == [1, 1, 2]


def test_exact_groups(docs, rows_):
    assert by_id(exact_dedup.exact_groups(docs), "keep_id", "group_size", "kept", "text_sha256") == brute.exact(rows_)


def test_exact_groups_survive_hash_collisions(docs, rows_):
    got = by_id(exact_dedup.exact_groups(docs, lambda text: F.lit(b"same")), "keep_id", "group_size", "kept", "text_sha256")
    assert got == brute.exact(rows_)


def test_exact_drop_keeps_columns_and_one_row(spark, docs, rows_):
    left = exact_dedup.drop_copies(docs.union(docs.where("doc_id = 16")))
    assert left.columns == docs.columns
    assert sorted(row.doc_id for row in left.collect()) == sorted(d for d, v in brute.exact(rows_).items() if v[2])


def test_exact_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (2, "a"), (None, "b")], "doc_id long, text string")
    got = sorted((row.doc_id is None, row.keep_id, row.group_size, row.kept) for row in exact_dedup.exact_groups(df).where("keep_id = 2").collect())
    assert got == [(False, 2, 2, True), (True, 2, 2, False)]
    assert [row.doc_id for row in exact_dedup.drop_copies(df).collect()] == [2]


def test_dedup_stages_lose_no_text(spark):
    import corpus_pipeline

    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    rows = [(None, a), (2, a), (5, a), (None, b), (None, b.replace(" ", "  ")), (3, c), (3, d), (3, d), (None, c + " more"), (None, None)]
    df = spark.createDataFrame([(*row, "clash") for row in rows], "doc_id long, text string, rank string")
    exact = corpus_pipeline.exact_dedup_stage(spark, df, "")
    assert exact.columns == df.columns
    left = sorted((row.doc_id or 0, " ".join((row.text or "").split())) for row in exact.collect())
    assert left == sorted([(2, a), (0, b), (3, c), (3, d), (0, c + " more"), (0, "")])
    near = corpus_pipeline.near_dedup_stage(spark, exact, "")
    assert near.columns == df.columns
    left = sorted((row.doc_id or 0, " ".join((row.text or "").split())) for row in near.collect())
    assert left == sorted([(2, a), (0, b), (3, c), (3, d), (0, "")])


def test_pii_base_spans(docs, rows_):
    got = by_id(pii.find_pii(docs), "base", "spans")
    for doc_id, text in rows_:
        base = [f"{s.kind}:{s.start}:{s.end}" for s in got[doc_id][0]]
        assert base == brute.personal(text)
        assert got[doc_id][1][: len(base)] == got[doc_id][0]


def test_pii_trees_add_spans_in_context(spark):
    lines = [f"call me on +1 (2{k:02d}) 555-{1000 + k} today" for k in range(60)] + [f"in {1900 + k} there were {k} of them, not {k}.{k}" for k in range(60)]
    extra = "call me on 1 (299) 555-1999 today"
    df = spark.createDataFrame([*enumerate(lines), (999, extra)], "doc_id long, text string")
    got = by_id(pii.find_pii(df), "base", "spans")
    assert got[999][0] == [] and all(s.kind == "other" for s in got[999][1])
    assert all(len(got[k][0]) == 1 for k in range(60)) and all(got[k][1] == [] for k in range(60, 120))


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_contamination(docs, rows_, items, block_words):
    found = decontaminate.leaks(docs, items, block_words=block_words)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    got = by_id(found.select("doc_id", "n_words", hit.alias("hit"), F.size("items").alias("n"), F.sha2(F.array_join("items", ","), 256).alias("sha"), (F.size("spans") > 0).alias("bad")), "n_words", "hit", "n", "sha", "bad")
    assert got == brute.contaminated(rows_, [tuple(row) for row in items.collect()])


def test_pii_trees_are_fitted_on_all_candidates(spark, monkeypatch):
    fit, seen = pii.GBTClassifier.fit, []
    monkeypatch.setattr(pii.GBTClassifier, "fit", lambda self, df, *more: (seen.append(df), fit(self, df, *more))[1])
    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('mail a', id, '@b.org or call 12 34 56 78 ', id) AS text")
    spans = pii.candidates(docs)
    pii.score_candidates(spans)
    n, weigh = spans.where("kind IS NOT NULL").count(), F.sum("weight") if "weight" in seen[0].columns else F.count("*")
    assert n > 40_000 and 0.78 * n < seen[0].agg(weigh).first()[0] < 0.82 * n


def test_removing_leaks(docs, rows_, items):
    pairs = [tuple(row) for row in items.collect()]
    want = brute.contaminated(rows_, pairs)
    left = {row.doc_id: row for row in decontaminate.remove_leaks(docs, items, max_share=0.5).collect()}
    assert set(left) == {d for d, v in want.items() if v[1] <= 0.5 * v[0]}
    after = brute.contaminated([(d, row.text) for d, row in left.items()], pairs)
    assert not any(v[4] for v in after.values())
    texts = dict(rows_)
    assert all(row.text == texts[d] and row.n_chars is None for d, row in left.items() if not want[d][4])
    assert all(row.n_chars == len(row.text) for d, row in left.items() if want[d][4])


def test_many_automata_equal_one(spark):
    w = [f"w{k}" for k in range(80)]
    join = " ".join
    items = spark.createDataFrame([(1, join(w[:14])), (2, join(w[8:24])), (3, join(w[40:52])), (4, join(w[36:40] + w[52:60]))], "item_id long, text string")
    texts = [(1, join(["x"] * 40 + w[:24] + ["y"] * 9)), (2, join(["x"] * 30 + w[36:60] + ["y"] * 9)), (2, join(["x"] * 40 + w[8:24])), (2, join(["x"] * 3)), (None, join(["x"] * 40 + w[:14])), (None, "z"), (None, None), (5, join(w[:14])), (6, join(w[:14] + ["v"] * 20))]
    df = spark.createDataFrame([(d, t, 7) for d, t in texts + texts[:1]], "doc_id long, text string, n_chars long")
    found, left = [], []
    for block_words in (1_000_000, 8):
        assert len(decontaminate.automata(items, block_words=block_words)) == (1 if block_words > 8 else 7)
        found.append(sorted((repr(tuple(row)) for row in decontaminate.leaks(df, items, block_words=block_words).collect())))
        left.append(sorted((repr(tuple(row)) for row in decontaminate.remove_leaks(df, items, block_words=block_words).collect())))
    assert len(found[0]) == len(texts) + 1 and found[0] == found[1]
    assert left[0] == left[1] and not any("w" in row for row in left[1])


@pytest.mark.parametrize("block_words", [1_000_000, 8])
def test_items_without_an_id_hit(spark, block_words):
    w = [f"w{k}" for k in range(30)]
    items = spark.createDataFrame([(None, " ".join(w[:12])), (None, "w20 w21"), (7, " ".join(w[10:25]))], "item_id long, text string")
    df = spark.createDataFrame([(1, " ".join(["x"] * 3 + w[:12])), (2, " ".join(w[10:22])), (3, "w21 w20")], "doc_id long, text string")
    found = {row.doc_id: ([tuple(s) for s in row.spans], row["items"]) for row in decontaminate.leaks(df, items, block_words=block_words).collect()}
    assert found == {1: ([(3, 15)], []), 2: ([(0, 12)], ["7"]), 3: ([], [])}


def test_columns_that_are_called_like_inner_ones(spark, items):
    import corpus_pipeline

    names = ["_row", "_ROW_", "_words", "_cut", "_id", "_group", "_text", "_round", "_hot", "_salt", "hash"]
    text = " ".join(f"a{k}" for k in range(40))
    rows = [(d, t, *(f"{n}{d}" for n in names)) for d, t in ((1, text), (2, text), (3, text + " b"), (4, "other words"), (5, "stone river and more of it that nobody asked about"))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for stage, left in ((exact_dedup.drop_repeats, {1, 3, 4, 5}), (exact_dedup.drop_copies, {1, 3, 4, 5}), (near_dedup.drop_near_copies, {1, 4, 5})):
        found = stage(df)
        assert found.columns == df.columns
        assert {tuple(row) for row in found.collect()} == {row for row in rows if row[0] in left}
    for block_words in (1_000_000, 5):
        found = decontaminate.remove_leaks(df, items, block_words=block_words)
        assert found.columns == df.columns
        cut = {row.doc_id: row for row in found.collect()}
        assert set(cut) == {1, 2, 3, 4, 5} and "stone" not in cut[5].text
        assert all(tuple(cut[row[0]])[2:] == row[2:] for row in rows) and all(cut[d].text == rows[d - 1][1] for d in (1, 2, 3, 4))
    assert corpus_pipeline.exact_dedup_stage(spark, df, "").columns == df.columns


def test_no_items_no_leaks(docs, items):
    found = decontaminate.leaks(docs, items.limit(0))
    assert found.where("size(spans) > 0").count() == 0 and found.count() == docs.count()
    assert decontaminate.remove_leaks(docs, items.limit(0)).count() == docs.count()


def test_long_repeats(docs, rows_):
    found = suffix_dedup.long_repeats(docs).withColumn("n", F.size("spans").cast("long"))
    assert by_id(found, "n_bytes", "n_removed", "n", "kept_sha256") == brute.repeats(rows_)


def test_long_repeats_in_short_lengths_and_many_parts(docs, rows_):
    found = suffix_dedup.long_repeats(docs, length=20, piece=8, part_bytes=4_000).withColumn("n", F.size("spans").cast("long"))
    assert by_id(found, "n_bytes", "n_removed", "n", "kept_sha256") == brute.repeats(rows_, 20)


@pytest.mark.parametrize("index_texts", [0, 2])
def test_long_repeats_of_crowded_seeds(docs, rows_, index_texts):
    found = suffix_dedup.long_repeats(docs, length=20, piece=8, part_bytes=4_000, index_texts=index_texts).withColumn("n", F.size("spans").cast("long"))
    assert by_id(found, "n_bytes", "n_removed", "n", "kept_sha256") == brute.repeats(rows_, 20)


def test_long_repeats_of_a_phrase_in_many_surroundings(spark):
    import random

    rng = random.Random(3)
    sign = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    phrase, tails = "the same forty byte phrase in every text", [sign(9) for _ in range(40)]
    rows = [(k, sign(30) + phrase + rng.choice(tails) + sign(20)) for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for index_texts in (50, 8_000):
        found = suffix_dedup.long_repeats(df, length=45, index_texts=index_texts).withColumn("n", F.size("spans").cast("long"))
        assert by_id(found, "n_bytes", "n_removed", "n", "kept_sha256") == brute.repeats(rows, 45)


def test_run_index_is_compressed_and_right():
    import numpy as np

    base = b"the quick brown fox jumps over the lazy dog and runs"
    texts = [base, base[:-4] + b"hops", b"zz" + base] * 5
    owners = np.arange(15) + 100
    index = suffix_dedup.RunIndex(texts, owners, 12)
    assert len(index.run_start) < sum(map(len, texts)) / 2
    for text, least in zip(texts, index.earliest()):
        assert least.tolist() == [min(o for t, o in zip(texts, owners) if text[k : k + 12] in t) for k in range(len(text) - 11)]


def test_secrets(docs, rows_):
    got = by_id(secrets.find_secrets(docs), "spans")
    for doc_id, text in rows_:
        assert [f"{s.kind}:{s.start}:{s.end}" for s in got[doc_id][0] if s.kind != "random"] == brute.secrets(text)
    texts = dict(rows_)
    added = [texts[d][s.start : s.end] for d, (spans,) in got.items() for s in spans if s.kind == "random"]
    assert added == ["qZ7xW9vB3nM5kL1pT8rY2"]


def test_random_strings_behind_plain_words():
    import random
    import string

    encoding, rng = secrets.vocabulary(secrets.default_vocabulary()), random.Random(3)
    for before in ("", "https://example.com/download/archive/", "session_cookie_value=", "/services/notifications/incoming/webhook/"):
        for alphabet in (string.ascii_letters + string.digits, string.ascii_letters):
            for size in (16, 24, 32):
                for _ in range(50):
                    text = f"see {before}{''.join(rng.choice(alphabet) for _ in range(size))} now"
                    found = secrets.random_spans(text, [], encoding, 2.0)
                    assert any(a <= 4 + len(before) and b >= 4 + len(before) + size for a, b, _ in found), text
    for plain in ("https://example.com/download/archive/latest/index.html", "3f2504e0-4f89-11d3-9a0c-0305e82c3301", "MAXIMUM_NUMBER_OF_RETRIES", "4539148803436468"):
        assert secrets.random_spans(plain, [], encoding, 2.0) == []


def test_near_groups(docs, rows_):
    got = by_id(near_dedup.near_groups(docs, words=4), "n_shingles", "component_id", "kept")
    assert got == brute.near(rows_, 4)


def test_near_groups_of_repeated_rows(spark, docs, rows_):
    pairs = []
    for k in range(6):
        left = [f"p{k}w{i}" for i in range(103)]
        right = left[:93] + [f"q{k}w{i}" for i in range(10)]
        pairs += [(10_000 + 2 * k, " ".join(left)), (10_001 + 2 * k, " ".join(right))]
    extra = spark.createDataFrame(pairs, "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra)
    want = brute.near(rows_ + pairs, 4)
    assert all(want[d + 1][1] == d for d in range(10_000, 10_012, 2))
    once = rows.union(extra.where("doc_id IN (10000, 10003)"))
    for read in (rows.union(rows), once):
        got = near_dedup.near_groups(read, words=4)
        assert by_id(got, "n_shingles", "component_id", "kept") == want and got.count() == read.count()


def test_near_groups_unite_the_texts_of_an_id(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:40])), (2, " ".join(words[37:])), (3, " ".join(words[:40])), (None, " ".join(words)), (None, ""), (4, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((row.doc_id or 0, row.n_shingles, row.component_id or 0, row.kept) for row in near_dedup.near_groups(df, words=4).collect())
    assert [r for r in got if r[0]] == [(1, 57, 1, True), (2, 57, 1, False), (2, 57, 1, False), (3, 37, 3, True), (4, 0, 4, True), (4, 0, 4, True)]


def test_near_groups_of_words_and_threshold(docs, rows_):
    got = by_id(near_dedup.near_groups(docs, words=5, percent=60), "n_shingles", "component_id", "kept")
    assert got == brute.near(rows_, 5, 60)


def test_sketches_fill_every_coordinate_and_estimate():
    import numpy as np

    rng = np.random.default_rng(1)
    for shared in (1, 40, 400):
        common, a, b = (rng.integers(1, 1 << 62, n, dtype=np.uint64) for n in (shared * 8, shared, shared))
        values = [np.unique(np.concatenate((common, x))) for x in (a, b)]
        found = near_dedup.sketches(np.concatenate(values), np.array([0, len(values[0]), len(values[0]) + len(values[1])]), 252)
        assert (found != near_dedup._EMPTY).all()
        assert abs((found[0] == found[1]).mean() - 0.8) < 0.12


def test_components_of_long_chains(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {row.node: row.component for row in near_dedup.components(links).collect()}
    assert got == {**dict.fromkeys(range(2, 41), 1), 101: 100}


def test_bpe_equals_the_library(docs, rows_):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_vocabulary())
    got = by_id(bpe.token_digests(docs), "n_tokens", "ids_sha256", "decoded_sha256")
    lists = by_id(bpe.encode(docs), "tokens")
    back = by_id(bpe.decode(bpe.encode(docs)), "decoded", "readable")
    for doc_id, text in rows_:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert lists[doc_id][0] == ids and back[doc_id][0] == decoded
        assert got[doc_id] == (len(ids), brute.sha(b"".join(i.to_bytes(4, "little") for i in ids)), brute.sha(decoded))
    assert back[4 * 3 + 1][1] == "two words"


def test_bpe_on_random_strings():
    import random

    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    library, rng = Tokenizer.from_file(path), random.Random(2)
    labels = [label.replace("</w>", "") for label in library.get_vocab()]
    for k in range(4_000):
        text = "".join(rng.choice("aeionrstlhd'0129ésüß .,-<|>/w") for _ in range(20)) if k % 2 else "".join(rng.choice(labels) for _ in range(3))
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode_text(text, path)[0] == b"".join(i.to_bytes(4, "little") for i in ids)


def test_language(spark):
    sample = {"en": "the bird walks over the green house and the river of stone", "de": "der vogel geht über das grüne haus und den fluss aus stein", "fr": "l'oiseau marche sur la maison verte et la rivière de pierre"}
    rows = [(k, f"{sample[lang]} {k}", lang) for k, lang in enumerate(list(sample) * 12)] + [(900, None, "en"), (901, "12 34 !", None), (902, "", "fr"), (903, "die flussvögel", None), (904, "the river", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    out = F.coalesce(language.held_out(F.col("doc_id")), F.lit(False))
    got = by_id(language.predict(df, language.fit(df.where(~out))), "lang_pred", "score")
    assert all(got[d][0] == lang for d, _, lang in rows[:36])
    assert got[900] == got[901] == got[902] == ("und", 0.0) and got[903][0] == "de" and got[904][0] == "en"
    assert all(0 <= score <= 1 for _, score in got.values())
    assert {row.doc_id for row in language.keep_known(df).collect()} == {d for d in got if d not in (900, 901, 902)}


def test_held_out_by_crc(spark):
    import zlib

    got = spark.range(300).select("id", language.held_out(F.col("id")).alias("out")).collect()
    assert all(row.out == (zlib.crc32(str(row.id).encode()) % 3 == 1) for row in got)


def test_nothing_learned(spark, docs):
    got = language.predict(docs, language.fit(docs.limit(0)))
    assert {tuple(row) for row in got.select("lang_pred", "score").distinct().collect()} == {("und", 0.0)}


def turns(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string").withColumn("side", F.lit("clash"))


def test_preference_prefix_and_mask(spark):
    chosen = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "good"), (2, 0, "user", "same"), (3, 0, "user", "alone"), (4, 0, "user", "a"), (4, 5, "assistant", None), (4, 5, "assistant", None), (None, 0, "user", "x")]
    rejected = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "bad"), (1, 3, "user", "why"), (1, 4, "assistant", "worse"), (2, 0, "user", "same"), (4, 0, "user", "b")]
    pairs = {row.pair_id: row for row in preference.preference_pairs(turns(spark, chosen), turns(spark, rejected)).collect()}
    head = lambda role, text: f"<|{role}|>\n{text}\n<|end|>\n"
    assert set(pairs) == {1, 2, 4}
    assert pairs[1].prompt == head("system", "s") + head("user", "u") and pairs[1].chosen == head("assistant", "good")
    assert pairs[1].rejected == head("assistant", "bad") + head("user", "why") + head("assistant", "worse")
    assert [pairs[1].rejected[m.start : m.end] for m in pairs[1].rejected_mask] == [head("assistant", "bad"), head("assistant", "worse")]
    assert pairs[2].prompt == head("user", "same") and pairs[2].chosen == pairs[2].rejected == "" and pairs[2].chosen_mask == []
    assert pairs[4].prompt == "" and pairs[4].chosen == head("user", "a") + head("assistant", "") and pairs[4].rejected_mask == []


def test_every_conversation_makes_a_pair(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "bye"),
        (2, 0, "user", "q"), (2, 1, "assistant", "only"), (2, 2, None, "end"),
        (3, 0, "user", "nobody"), (3, 1, None, "answers"),
        (4, 0, "assistant", ""), (5, 0, "assistant", "x"), (5, 0, "user", "y"), (5, 0, "user", "y"), (None, 0, "user", "gone"), (6, None, "user", "gone"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("side", F.lit("clash"))
    got = {tuple(row) for row in preference.preference_turns(*preference.swapped_answers(df)).collect()}
    say = lambda *turns_: "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns_)
    assert got == {
        (1, "prompt", 0, say(("user", "q")), False), (1, "prompt", 1, say(("assistant", "a")), False), (1, "prompt", 2, say(("user", "r")), False),
        (1, "chosen", 3, say(("assistant", "b")), True), (1, "chosen", 4, say(("user", "bye")), False),
        (1, "rejected", 3, say(("assistant", "a")), True), (1, "rejected", 4, say(("user", "bye")), False),
        (2, "prompt", 0, say(("user", "q")), False), (2, "chosen", 1, say(("assistant", "only")), True), (2, "chosen", 2, say(("", "end")), False),
        (2, "rejected", 1, say(("assistant", "")), True), (2, "rejected", 2, say(("", "end")), False),
        (3, "prompt", 0, say(("user", "nobody")), False), (3, "prompt", 1, say(("", "answers")), False),
        (4, "prompt", 0, say(("assistant", "")), False),
        (5, "chosen", 0, say(("assistant", "x"), ("user", "y")), False), (5, "rejected", 0, say(("assistant", ""), ("user", "y")), False),
    }


def test_run_index_of_few_short_texts():
    import numpy as np

    for texts in ([b"a" * 20 + b"bc"], [b"x" * 33, b"y" * 12 + b"xx"]):
        owners = np.arange(len(texts)) + 7
        found = suffix_dedup.RunIndex(texts, owners, 12).earliest()
        assert [f.tolist() for f in found] == [[7 + k] * (len(t) - 11) for k, t in enumerate(texts)]


def test_empty_tables(spark, empty, items):
    assert license_scan.scan_licenses(empty).count() == 0
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0
    assert pii.find_pii(empty).count() == 0
    assert decontaminate.leaks(empty, items).count() == 0 and decontaminate.remove_leaks(empty, items).count() == 0
    assert suffix_dedup.long_repeats(empty).count() == 0
    assert secrets.find_secrets(empty).count() == 0
    assert near_dedup.near_groups(empty).count() == 0 and near_dedup.drop_near_copies(empty).count() == 0
    assert bpe.encode(empty).count() == 0 and bpe.token_digests(empty).count() == 0
    assert language.keep_known(empty).count() == 0
    none = turns(spark, [])
    assert preference.preference_turns(none, none).count() == 0


def test_strings_of_crowded_seeds_meet_without_a_join_and_cover_one_span(spark):
    import pyarrow as pa

    contexts = spark.createDataFrame([(3, 1, 10, bytearray(b"xabcdy")), (1, 1, 11, bytearray(b"zabcdy")), (2, 1, 12, bytearray(b"xabcq")), (9, 2, 13, bytearray(b"abcd"))], "doc_id long, hash long, mark long, context binary")
    found = suffix_dedup._by_strings(contexts, 4)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    runs = {row["mark"]: sorted(tuple(run) for run in row["runs"]) for row in found.collect()}
    assert runs == {10: [(0, 0, 2), (0, 2, 3), (1, 1, 1), (2, 2, 1)], 11: [(0, 2, 1)], 12: [(0, 1, 2)], 13: [(0, 0, 9)]}
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    cover = pa.array([[{"a": 90, "b": 99}], [{"a": 5, "b": 9}, {"a": 0, "b": 5}, {"a": 1, "b": 2}, {"a": 11, "b": 12}], [], [{"a": 0, "b": 1}]], kind)
    assert suffix_dedup._united(cover) == [[(90, 99)], [(0, 9), (11, 12)], [], [(0, 1)]]
    assert suffix_dedup._united(cover.slice(1, 2)) == [[(0, 9), (11, 12)], []] and suffix_dedup._united(cover.slice(2, 1)) == [[]]


def test_only_the_first_document_of_a_context_asks_for_its_strings(spark):
    """Later ones are covered; a frequent string's rows scatter."""
    head, tail = "a seed of many letters in the middle of it all, ", "which goes on and on and on with more letters"
    rows = [(k, f"{k % 3} {k % 3} {k % 3} " + head + tail) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    roles = {row["doc_id"]: {role & 3 for role in row["roles"]} for row in suffix_dedup.seed_roles(docs, 50, 24, 4).collect()}
    assert all(found == {suffix_dedup.COVERED} for doc_id, found in roles.items() if doc_id > 2) and suffix_dedup.FIRST in roles[1]
    found = suffix_dedup.long_repeats(docs, index_texts=1).withColumn("n", F.size("spans").cast("long"))
    assert by_id(found, "n_bytes", "n_removed", "n", "kept_sha256") == brute.repeats(rows, 50)
    contexts = spark.createDataFrame([(5, 1, mark, bytearray(b"abcd")) for mark in range(200)] + [(4, 1, 999, bytearray(b"abcd"))], "doc_id long, hash long, mark long, context binary")
    runs = {row["mark"]: {tuple(run) for run in row["runs"]} for row in suffix_dedup._by_strings(contexts, 4).collect()}
    assert runs.pop(999) == {(0, 0, 4)} and all(found == {(0, 0, 5), (0, 0, 4)} for found in runs.values())
    assert "salt" in suffix_dedup._by_strings(contexts, 4)._jdf.queryExecution().optimizedPlan().toString()


def test_a_text_that_repeats_a_context_sends_it_once(spark, monkeypatch):
    """So its seed is not crowded, and its rows do not follow the repeats."""
    crowded = []
    by_strings = suffix_dedup._by_strings
    monkeypatch.setattr(suffix_dedup, "_by_strings", lambda contexts, length: crowded.append(contexts) or by_strings(contexts, length))
    line = "one very common line that stands in the text again and again, "
    rows = [(1, line * 200 + "and ends so"), (2, "begins otherwise: " + line * 150), (3, "x " + line + "y")]
    found = suffix_dedup.long_repeats(spark.createDataFrame(rows, "doc_id long, text string"), index_texts=40).withColumn("n", F.size("spans").cast("long"))
    assert by_id(found, "n_bytes", "n_removed", "n", "kept_sha256") == brute.repeats(rows, 50)
    assert crowded[0].count() == 0


def test_seeds_fall_evenly_into_parts():
    """Their hashes are the lowest of many, so ranges of the hashes themselves would give the first part most of them."""
    import numpy as np

    data = np.random.default_rng(4).integers(97, 123, 200_000, dtype=np.uint8)
    hashes = suffix_dedup.seeds(data, np.array([0, len(data)]), 50, 24)[2]
    for parts in (12, 85):
        counts = np.bincount(suffix_dedup._part(hashes, parts), minlength=parts)
        assert counts.max() < 1.5 * counts.mean() and counts.min() > counts.mean() / 1.5


def test_an_index_holds_few_contexts_and_runs_are_right(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    hashes = np.repeat(np.arange(30), 20)
    owners, marks = rng.permutation(len(hashes)), np.arange(len(hashes))
    texts = [bytes(rng.integers(97, 99, 5, dtype=np.uint8)) + b"seed%02d" % k + bytes(rng.integers(97, 99, 5, dtype=np.uint8)) for k in hashes]
    built = []
    index = suffix_dedup.RunIndex
    monkeypatch.setattr(suffix_dedup, "RunIndex", lambda part, *rest: built.append(len(part)) or index(part, *rest))
    for size, sizes in ((50, [40] * 15), (10, [20] * 30), (10_000, [600])):
        monkeypatch.setattr(suffix_dedup, "INDEX_SIZE", size)
        built.clear()
        rows = [row for batch in suffix_dedup._earliest(texts, owners, hashes, marks, 11) for row in batch.to_pylist()]
        assert built == sizes and [row["mark"] for row in rows] == marks.tolist()
        for row, text, seed in zip(rows, texts, hashes):
            least = [min(o for t, o, h in zip(texts, owners, hashes) if h == seed and text[k : k + 11] in t) for k in range(len(text) - 10)]
            assert [run["first"] for run in row["runs"] for _ in range(run["low"], run["high"] + 1)] == least and row["hash"] == seed
            assert all(x["first"] != y["first"] and x["high"] + 1 == y["low"] for x, y in zip(row["runs"], row["runs"][1:]))


def test_batches_end_by_what_their_rows_unpack_to(spark):
    """Packed rows are small, whatever they stand for."""
    from tallyframe.llm.common import BATCH_BYTES, map_batches

    third = BATCH_BYTES // 3 + 1
    df = spark.createDataFrame([(k, size) for k, size in enumerate([third] * 5 + [4 * BATCH_BYTES] + [1] * 20)], "id long, size int").coalesce(1)
    seen = [row["ids"] for row in map_batches(df, lambda batch: [[batch.column("id").to_pylist()]], "ids array<long>", "size").collect()]
    assert sorted(k for ids in seen for k in ids) == list(range(26))
    sizes = {row["id"]: row["size"] for row in df.collect()}
    assert all(len(ids) == 1 or sum(sizes[k] for k in ids) <= BATCH_BYTES for ids in seen)


def test_long_texts_of_few_lines(spark):
    rows = [(k, f"{k} is a text of its own. " + f"a line of {k % 2} that comes again and again, and again, " * (5 + k)) for k in range(12)]
    found = suffix_dedup.long_repeats(spark.createDataFrame(rows, "doc_id long, text string"), part_bytes=500).withColumn("n", F.size("spans").cast("long"))
    assert by_id(found, "n_bytes", "n_removed", "n", "kept_sha256") == brute.repeats(rows, 50)
