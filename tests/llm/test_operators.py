"""The ten operators and the pipeline against brute force, on edge rows and a small table."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsmine.llm import exact, jaccard, langid, packing, pieces, quality, substrings, suffixes, tokencount, urlfilter

tokens = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, anchor long, id string, cls string"


def prose(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * 17) % 9973}" for i in range(n))


BASE = prose(1, 300)
ROWS = [
    (1, BASE), (2, BASE), (2, BASE), (3, BASE.replace("w", "W", 1)), (4, None), (5, ""), (6, " \t\n"),
    (7, prose(2, 40) + " " + BASE), (8, prose(3, 30) + "\nAnother line here. ÄÖ 漢字 😀 <|endoftext|> end."),
    (None, prose(4, 50)), (9, "short."), (10, "a " * 400), (11, prose(5, 25) + "\r\n" + prose(5, 25)), (12, "x" * 3000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if k % 2 else "de", None, None, k, "x", None) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, *names):
    return sorted(((r["doc_id"], *[r[n] for n in names]) for r in df.collect()), key=repr)


def test_exact(docs, none):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in ROWS]
    size, low = Counter(t for _, t in norm), {}
    for i, t in norm:
        low[t] = min(low.get(t, (1, 0)), (0, i) if i is not None else (-1, None), key=lambda x: (x[0], x[1] or 0))
    expected = sorted(((i, low[t][1], size[t], i == low[t][1], hashlib.sha256(t.encode()).hexdigest()) for i, t in norm), key=repr)
    assert by_id(exact.duplicates(docs, digest=True), "keep_id", "group_size", "kept", "text_sha256") == expected
    assert by_id(exact.duplicates(docs), "keep_id", "group_size") == sorted(((e[0], e[1], e[2]) for e in expected), key=repr)
    assert exact.deduplicated(docs).columns == docs.columns
    assert exact.duplicates(none).count() == 0


def test_substrings(docs, none):
    window, seen, expected = 20, {}, []
    order = sorted({(-1 if i is None else i, t or "") for i, t in ROWS})
    removed = {}
    for i, t in order:
        w = WORD.findall(t)
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if seen.setdefault(tuple(w[p : p + window]), (i, p)) != (i, p):
                gone[p : p + window] = [True] * window
        removed[i, t] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    expected = sorted(((i, *removed[-1 if i is None else i, t or ""]) for i, t in ROWS), key=repr)
    assert by_id(substrings.without_repeats(docs), "n_words", "n_removed", "kept") == expected
    assert substrings.without_repeats(none).count() == 0


def test_suffixes(docs, none):
    window = 400
    texts = {(-1 if i is None else i, t or "") for i, t in ROWS}
    starts = Counter(b[p : p + window] for _, t in texts for b in [t.encode()] for p in range(len(b) - window + 1))
    result = {}
    for i, t in texts:
        b = t.encode()
        gone = [False] * len(b)
        for p in range(len(b) - window + 1):
            if starts[b[p : p + window]] > 1:
                gone[p : p + window] = [True] * window
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        result[i, t] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g))
    expected = sorted(((i, *result[-1 if i is None else i, t or ""]) for i, t in ROWS), key=repr)
    found = [(r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffixes.without_repeats(docs).collect()]
    assert sorted(found, key=repr) == expected
    assert suffixes.deduplicated(docs).columns == docs.columns
    assert suffixes.without_repeats(none).count() == 0


def test_jaccard(docs, none):
    sets = []
    for i, t in ROWS:
        w = WORD.findall((t or "").lower())
        sets.append((i, set(zip(w, w[1:], w[2:], strict=False)) if len(w) > 2 else ({tuple(w)} if w else set())))
    root = list(range(len(sets)))
    for _ in sets:
        for x, (_, a) in enumerate(sets):
            for y, (_, b) in enumerate(sets):
                if a and b and 100 * len(a & b) >= 90 * len(a | b):
                    root[x] = root[y] = min(root[x], root[y])
    lowest = {r: min(s[0] for s, q in zip(sets, root, strict=True) if q == r and s[0] is not None) for r in set(root) if any(s[0] is not None for s, q in zip(sets, root, strict=True) if q == r)}
    expected = sorted(((i, len(s), lowest.get(r)) for (i, s), r in zip(sets, root, strict=True)), key=repr)
    assert by_id(jaccard.near_duplicates(docs), "n_shingles", "component_id") == expected
    assert jaccard.near_duplicates(none).count() == 0


def test_pipeline_cuts_passages_of_over_50_words(spark):
    passages = [" ".join(f"wor{(k * 37 + i * i) % 97}" for i in range(n)) for k, n in ((1, 51), (2, 60))]
    assert all(250 < len(p) < 400 for p in passages)
    fill = [prose(k, 40) for k in range(30, 38)]
    rows = [(k, f"{fill[2 * k]} {passages[k // 2]} {fill[2 * k + 1]}") for k in range(4)] + [(4, prose(40, 100))]
    texts = [(r["doc_id"], r["text"]) for r in corpus_pipeline.suffix_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()]
    for i, t in texts:
        if i < 4:
            assert fill[2 * i][:-8] in t and fill[2 * i + 1][8:] in t and passages[i // 2][8:-8] not in t and len(t) < len(rows[i][1]) - 250
    assert dict(texts)[4] == rows[4][1]


def test_components_of_a_long_chain(spark):
    names = [int.from_bytes(hashlib.sha256(str(k).encode()).digest()[:8], "big", signed=True) for k in range(1000)]
    links = [*zip(names, names[1:], strict=False), (5, 4), (4, 5), (4, 3), (7, 7)]
    found = {r["node"]: r["comp"] for r in jaccard.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(names, min(names)), 3: 3, 4: 3, 5: 3, 7: 7}
    assert jaccard.components(spark.createDataFrame([], "a long, b long")).count() == 0


def edited(k, size=120, versions=12):
    """Versions of one text, each with one more word changed than the one before; some with a word more."""
    own = prose(k, size).split(" ")
    for v in range(versions):
        at = (v * 41 + k) % size
        own = [*own[:at], f"new{k}x{v}", *own[at + (v % 3 > 0) :]]
        yield " ".join(own)


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_all_links(spark, words, percent):
    texts = [t for k in (51, 52, 53) for t in edited(k)]
    texts += [f"{prose(54, 200)} {prose(60 + k, 4)}" for k in range(8)]
    grams = [set(zip(*(t.split(" ")[i:] for i in range(words)), strict=False)) for t in texts]
    expected = {}
    for x, one in enumerate(grams):
        for y in range(x):
            both = len(one & grams[y])
            if 100 * both >= percent * len(one | grams[y]):
                expected[y, x] = both
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = jaccard.joined(table, jaccard.Sets(words=words, percent=percent))
    ids = {r["cls"]: r["id"] for r in found.facts.collect()}
    links = [(*sorted((ids[r["a"]], ids[r["b"]])), r["overlap"]) for r in found.links.collect()]
    assert sorted(links) == sorted((*pair, both) for pair, both in expected.items())
    assert {ids[r["cls"]]: r["n_links"] for r in found.counts().collect()} == Counter(k for pair in expected for k in pair)
    root = list(range(len(texts)))
    for _ in texts:
        for x, y in expected:
            root[x] = root[y] = min(root[x], root[y])
    for peel in (False, True):
        found = jaccard.near_duplicates(table, jaccard.Sets(words=words, percent=percent, peel=peel))
        assert sorted(by_id(found, "component_id")) == list(enumerate(root))


def test_one_row_of_each_group_stays(spark):
    a, b, c, d = (prose(k, 60) for k in (21, 22, 23, 24))
    near = b + " tail"
    rows = [(3, a), (5, a), (5, b), (None, c), (None, c), (None, d), (7, d), (8, a.replace(" ", "  ")), (9, "x y"), (9, "x  y"), (9, "z"), (4, None), (4, "")]
    table = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `odd.name` int").repartition(3)
    kept = exact.deduplicated(table)
    assert kept.columns == table.columns
    found = sorted(((r[0], re.sub(" +", " ", r[1] or "")) for r in kept.collect()), key=repr)
    assert found == sorted([(3, a), (5, b), (None, c), (None, d), (9, "x y"), (9, "z"), (4, "")], key=repr)
    rows = [(3, a), (5, a + " tail"), (5, b), (5, near), (6, near), (None, c), (None, c), (None, c + " tail"), (7, d), (7, d), (8, ""), (8, "")]
    table = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `odd.name` int").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, table, "")
    assert kept.columns == table.columns
    found = sorted(((r[0], r[1].removesuffix(" tail")) for r in kept.collect()), key=repr)
    assert found == sorted([(3, a), (5, b), (None, c), (7, d), (8, ""), (8, "")], key=repr)


def test_quality(docs, none):
    found = {(r["doc_id"], r["word_chars"]): r for r in quality.line_quality(docs).collect()}
    for i, t in ROWS:
        w = WORD.findall(t or "")
        runs = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        cover = {k + j for k in range(len(w) - 7) if runs[tuple(w[k : k + 8])] > 1 for j in range(8)}
        row = found[i, sum(map(len, w))]
        assert (row["n_words"], row["n_repeat_words"]) == (len(w), len(cover))
        assert row["base_failed"] == (len(w) < 20 or 100 * len(cover) > 30 * len(w))
    assert quality.cleaned(docs).columns == docs.columns
    assert quality.line_quality(none).count() == 0


def test_tokens_and_pieces(docs, none):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    path = tokens.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    expected = sorted(((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False))) for i, t in ROWS), key=repr)
    assert by_id(tokencount.token_counts(docs, path), "n_bytes", "n_tokens") == expected
    path = tokens.path("piece_bpe_32k.model")
    model, own = SentencePieceProcessor(model_file=path), pieces.codec(path)
    for t in [*(t or "" for _, t in ROWS), "   a  b", "▁x", "\x00é", "aaaaaaa" * 9, " " * 40]:
        ids = model.encode(t)
        assert own.encode(t) == ids
        assert own.decode(ids) == model.decode(ids)
    expected = sorted(((i, len(model.encode(t or "")), hashlib.sha256(model.decode(model.encode(t or "")).encode()).hexdigest()) for i, t in ROWS), key=repr)
    assert by_id(pieces.digests(docs, path), "n_tokens", "decoded_sha256") == expected
    assert tokencount.token_counts(none, tokens.path("byte_bpe_50k.json")).count() == 0
    assert pieces.digests(none, path).count() == 0


def test_packing(docs, none):
    rows = packing.packed(docs, (256, 512, 1024)).collect()
    assert sum(r["length"] for r in rows) == sum(len((t or "").encode()) for _, t in ROWS)
    bins = {}
    for r in rows:
        if r["length"]:
            bins.setdefault((r["bin_id"], r["capacity"]), []).append((r["bin_offset"], r["length"]))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), own in bins.items():
        end = 0
        for at, length in sorted(own):
            assert at == end
            end += length
        assert end <= capacity and not any(end <= c < capacity for c in (256, 512))
    assert packing.packed(none).count() == 0


def test_packing_plan_is_best_fit():
    counts = {n: (n * 7) % 5 + 1 for n in range(1, 200, 3)}
    plan = packing.packed_plan(counts, (200,))
    rooms = []
    for n in sorted(counts, reverse=True):
        for _ in range(counts[n]):
            fits = [k for k, room in enumerate(rooms) if room >= n]
            if fits:
                k = min(fits, key=lambda k: rooms[k])
                rooms[k] -= n
            else:
                rooms.append(200 - n)
    assert sum(b[1] for b in plan.bins) == len(rooms)
    assert Counter(200 - u for _, m, u, _ in plan.bins for _ in range(m)) == Counter(rooms)


def test_language(spark, docs, none):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = langid.held_out(F.col("doc_id"))
    coder = langid.fitted(table.where(~held))
    found = langid.predicted(table, coder).join(table.where(held).select("doc_id", "lang"), "doc_id")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count()
    own = {r["doc_id"]: r for r in langid.predicted(docs, coder).collect()}
    assert own[4]["lang_pred"] == own[5]["lang_pred"] == own[6]["lang_pred"] == "und"
    assert langid.predicted(none, langid.fitted(none)).count() == 0


def test_urls(spark):
    rows = [(1, "https://a.example.com/en/1?q"), (2, "http://WWW.example.com/en/2#x"), (3, None), (4, "no scheme"), (5, "http://x.net/es/1"), (None, "http://best-casino.org/"), (6, "http://city-library.org/de/1"), (6, "://")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1))
    found = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urlfilter.url_verdicts(pages, urlfilter.labelled_urls(spark)).collect()]
    assert sorted(found, key=repr) == sorted([
        (1, "a.example.com", "/en/1", "example.com/en/", "block"), (2, "www.example.com", "/en/2", "www.example.com/en/", "allow"),
        (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "x.net", "/es/1", "net/es/", "block"),
        (None, "best-casino.org", "/", None, "block"), (6, "city-library.org", "/de/1", None, "allow"), (6, "", "", None, "allow"),
    ], key=repr)


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["length"] == 0 or r["bin_offset"] + r["length"] <= r["capacity"] for r in rows)
