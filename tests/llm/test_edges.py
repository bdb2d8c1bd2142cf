"""Borders of rows, clashing columns, many rows without doc_id, and a phrase that most texts hold."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsmine.llm import exact, jaccard, quality, queries, substrings, suffixes, urlfilter, windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * 17) % 9973}" for i in range(n))


def judged(spark, texts, parts=1):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(parts)
    found = {r["doc_id"]: tuple(r[k] for k in (*quality.FACTS, "base_failed", "kept")) for r in quality.line_quality(rows).collect()}
    kept = {r["doc_id"]: r["text"] for r in quality.cleaned(rows).collect()}
    return [(found[k], kept.get(k)) for k in range(len(texts))]


def test_phrases_do_not_reach_over_the_end_of_a_text(spark):
    one = prose(1, 18) + ". Please click "
    two = "here " + prose(2, 18) + "."
    three = "javascript is required " + prose(3, 18) + "."
    four = prose(4, 18) + ". You can enable "
    alone = [judged(spark, [t])[0] for t in (one, two, three, four)]
    assert [a[0][5] for a in alone[:2]] == [0, 0] and alone[2][0][5] > 0 and alone[3][0][5] == 0
    texts = [one, two, four, three, two, one, three, four]
    names = [0, 1, 3, 2, 1, 0, 2, 3]
    assert judged(spark, texts) == [alone[k] for k in names]
    assert judged(spark, texts, 4) == [alone[k] for k in names]


@pytest.mark.parametrize(
    ("word", "mark"),
    [("كلمة", "۔"), ("كلمة", "،"), ("शब्द", "।"), ("բառ", "։"), ("ቃል", "።"), ("λέξη", "·"), ("пословица", "."), ("词", "。"), ("စကား", "။")],
)
def test_long_lines_of_all_scripts_may_end_in_their_own_marks(spark, word, mark):
    text = " ".join(f"{word}{k}" for k in range(40)) + (mark if mark != "·" else "·")
    bare = text[:-1]
    (good, kept), (bad, gone) = judged(spark, [text, bare])
    assert good[-1] and kept == text and good[5] == 0
    assert not bad[-1] and gone is None and bad[5] > 0


def brute_quality(text, rules=quality.LineRules()):
    words = WORD.findall(text)
    runs = Counter(tuple(words[k : k + rules.window]) for k in range(len(words) - rules.window + 1))
    cover = {k + j for k in range(len(words) - rules.window + 1) if runs[tuple(words[k : k + rules.window])] > 1 for j in range(rules.window)}
    seen, again, lost, left = set(), 0, 0, []
    for line in re.split("(?<=\n)", text):
        own = WORD.findall(line)
        body = line.removesuffix("\n")
        chars = sum(map(len, own))
        symbols, bars, marks = (sum(line.count(c) for c in s) for s in ("#*$%&|<>", "|>", "!"))
        stops = sum(line.count(c) for c in ".!?;:," + quality.SENTENCE_MARKS)
        repeated = bool(own) and body in seen
        seen.add(body)
        again += repeated
        failed = 100 * symbols > rules.max_symbols * chars or 100 * marks > rules.max_marks * chars or (not stops and len(own) >= rules.unpunctuated_words)
        failed |= bars >= rules.separators and bars * rules.words_per_separator >= len(own)
        failed |= bool(quality.BOILERPLATE.search(line.encode())) and len(own) <= rules.boilerplate_words
        if own and (failed or repeated):
            lost += chars
        else:
            left.append(line)
    chars = sum(map(len, words))
    base = len(words) < rules.min_words or 100 * len(cover) > rules.max_repeat * len(words)
    kept = not base and 100 * lost <= rules.max_loss * chars
    return (len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), again, len(cover), lost, base, kept), "".join(left) if kept else None


def test_quality_against_brute_force(spark):
    docs = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    line = prose(7, 12) + "."
    docs += [f"{line}\n{line}\n\n{line}\r\n" + prose(8, 30) + ", ok", "a | b | c | d\n" + prose(9, 40) + ".", "Read more\n" + prose(10, 30) + ".\n!!!\n# # #", "", "\n\n", " \t\n"]
    assert judged(spark, docs, 3) == [brute_quality(t) for t in docs]


def test_columns_of_any_name_survive(spark):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(1, a, 10, "x", 1), (2, a, 20, "y", 2), (3, b, 30, "z", 3), (4, b + " tail", 40, "v", 4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, _id int, _mark string, row int")
    assert sorted(map(tuple, exact.deduplicated(table).collect())) == [rows[0], rows[2], rows[3]]
    kept = jaccard.deduplicated(table, jaccard.Sets(words=5, percent=80))
    assert kept.columns == table.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
    cut = suffixes.deduplicated(table, 200)
    assert cut.columns == table.columns and sorted(tuple(r)[2:] for r in cut.collect()) == [r[2:] for r in rows]


def brute_words(rows, window):
    """Words removed per row, in order of (doc_id, place in ``rows``); ids are distinct."""
    seen, out = {}, {}
    for i, t in sorted(rows):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[p : p + window]), (i, p)) != (i, p):
                gone[p : p + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def brute_bytes(rows, window):
    starts = Counter(b[p : p + window] for _, t in rows for b in [t.encode()] for p in range(len(b) - window + 1))
    out = {}
    for i, t in rows:
        b = t.encode()
        gone = [False] * len(b)
        for p in range(len(b) - window + 1):
            if starts[b[p : p + window]] > 1:
                gone[p : p + window] = [True] * window
        out[i] = (len(b), sum(gone), bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_a_phrase_that_most_texts_hold(spark, parts):
    phrase = prose(99, 30)
    rows = [(k, f"{prose(k, 25)} {phrase if k % 4 else phrase[: 100 + k]} {prose(k + 500, 10 + k % 30)}") for k in range(160)]
    rows += [(200 + k, rows[7][1][k:]) for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    for window in (20, 11):
        shape = windows.Shape(windows.word_units, window, window // 2, keep_first=True)
        texts = windows.texts_of(table)
        assert len(windows.frequent_anchors(texts, shape))
        found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substrings.without_repeats(table, window).collect()}
        assert found == brute_words(rows, window)
    for window in (100, 64):
        shape = windows.Shape(windows.byte_units, window, window // 4, keep_first=False)
        assert len(windows.frequent_anchors(windows.texts_of(table), shape))
        found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in suffixes.without_repeats(table, window).collect()}
        assert found == brute_bytes(rows, window)


def test_many_rows_without_doc_id(spark):
    shared = prose(77, 80)
    texts = [f"{prose(k, 20)} {shared if k % 3 == 0 else ''}" for k in range(60)]
    table = spark.createDataFrame([(None, t, k) for k, t in enumerate(texts)], "doc_id long, text string, k int").repartition(4)
    expected = brute_bytes(list(enumerate(texts)), 200)
    found = {r["k"]: r["text"].encode() for r in suffixes.deduplicated(table, 200).collect()}
    assert found == {k: v[2] for k, v in expected.items()}
    left = sorted(r["kept"] for r in substrings.without_repeats(table).select("kept").collect())
    assert sum("w" + str((77 * 7919) % 9973) in t for t in left) == 1
    assert substrings.without_repeats(table).agg(F.sum("n_removed")).first()[0] >= 19 * 70


def test_a_failed_run_leaves_no_table(spark):
    broken = spark.createDataFrame([(1, "x" * 900), (2, "x" * 900)], "doc_id long, text string").withColumn("text", F.when(F.col("doc_id") == 2, F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("text")))
    before = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception, match="broken"):
        suffixes.without_repeats(broken, 400).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_planted_passages_are_shorter_than_the_window_of_op8(spark, folder):
    """Passages of over 50 words that are planted in the test tables hold no 400 bytes: op8's window cannot reach them, the pipeline's can."""
    texts = [r["text"] for r in spark.read.parquet(f"/root/testdata/{folder}/benchmark.parquet").collect()]
    sizes = [len(t.encode()) for t in texts if t and len(WORD.findall(t)) > 50]
    assert len(sizes) >= 10 and 200 <= min(sizes) and max(sizes) < 400


def test_op8_counts_passages_of_over_50_words_beside_its_strings(spark, tmp_path):
    """Passages of 51 and 60 words are no strings of 400 bytes: they stay, and are counted; what is left alone has none."""
    passages = [prose(901, 51), prose(902, 60)]
    assert all(200 < len(p) < 400 for p in passages)
    rows = [(k, f"{prose(40 + k, 60)} {passages[k // 2]} {prose(60 + k, 60)}") for k in range(4)]
    rows += [(k, prose(80 + k, 150)) for k in range(4, 8)]
    chain = [prose(910 + k, 36 if k == 1 else 26) for k in range(3)]  # every string of 200 bytes in the whole repeats, none of 400 does
    rows += [(8, " ".join(chain)), (9, f"{prose(90, 30)} {chain[0]} {chain[1]}"), (10, f"{chain[1]} {chain[2]} {prose(91, 30)}")]
    rows += [(11, f"{prose(920, 90)} {prose(92, 20)}"), (12, f"{prose(93, 20)} {prose(920, 90)}"), (13, "x" * 700), (14, "y" * 300), (15, ""), (16, chain[1][:199])]
    spark.createDataFrame([*rows, (17, None)], "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.QUERIES["op8_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert found.pop(17)[1:] == (0, 0, 0, hashlib.sha256(b"").hexdigest(), 0)
    strings, short = brute_bytes(rows, 400), brute_bytes(rows, 200)
    assert {k: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for k, r in found.items()} == {k: (*v[:2], hashlib.sha256(v[2]).hexdigest()) for k, v in strings.items()}
    assert {k: r["n_passage"] for k, r in found.items()} == {k: v[1] for k, v in short.items()}
    assert all(found[k]["n_removed"] == 0 and found[k]["n_passage"] >= len(passages[k // 2]) for k in range(4))
    assert all(found[k]["n_passage"] == 0 for k in range(4, 8))
    assert found[8]["n_passage"] == found[8]["n_bytes"] > 400 and found[8]["n_removed"] == 0


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, _id int")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, none, "")
        assert found.count() == 0, name
        assert name == "best_fit_packing" or found.columns == none.columns
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urlfilter.url_verdicts(pages, urlfilter.labelled_urls(spark)).count() == 0
