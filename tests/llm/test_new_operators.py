"""Prefix trie, source mix and filter audit against brute force, on edge rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations
from math import isclose

import pytest
from pyspark.sql import functions as F

from newsmine.llm import filteraudit, mixing, turntrie

pytest.importorskip("public_tokenizers")  # llm.queries reads its paths
from newsmine.llm import queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, id string, mark int, part string, size int"


def prose(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * 17) % 9973}" for i in range(n))


def key(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute_trie(rows):
    """{path: row} of the rebuilt conversations."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((turn is not None, turn or 0, key(role, text)), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in turns.items()}
    found = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        found[c] = own.get(base, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in found.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    saved, leaves, children = Counter(), Counter(), Counter()
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, who in members.items():
        words = len(WORD.findall(path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(who) - 1) * words
            leaves[path[:d]] += not children[path]
    out = []
    for path, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(found[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


CONVERSATIONS = "conv_id long, turn long, role string, text string, ids int, key string, shard int"


def conversations():
    rows = [(c, t, "user" if t % 2 == 0 else "bot", f"word{(c // 7 + t) % 3} and {'x ' * ((c % 5) * (t > 2))}more") for c in range(0, 130) for t in range(c % 6)]
    rows += [(c, t, "user", "hello") for c in range(200, 300) for t in range(2)]  # one very common conversation
    rows += [(400, t, None, None) for t in range(300)]  # a long one
    rows += [(401, None, "a", ""), (401, None, "", "a"), (401, 1, "a", "b"), (401, 1, "a", "b"), (None, 0, "user", "lost"), (-7, 0, "user", "hello"), (-20, 0, "user", "hello")]
    return rows


@pytest.mark.parametrize("shard", [4, 50, 1 << 16])
def test_trie(spark, tmp_path, monkeypatch, shard):
    monkeypatch.setattr(turntrie, "SHARD", shard)
    rows = conversations()
    table = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], CONVERSATIONS).repartition(3)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    # Tasks import the module anew: the smaller shard has to reach them as well.
    records = turntrie._records

    def small(batches):
        turntrie.SHARD = shard
        yield from records(batches)

    monkeypatch.setattr(turntrie, "_records", small)
    assert trie_rows(queries.op11(spark, str(tmp_path))) == brute_trie(rows)


def test_trie_without_rows(spark):
    none = spark.createDataFrame([], CONVERSATIONS)
    assert turntrie.prefix_trie(turntrie.encoded(none)).count() == 0


def test_tree_is_balanced_by_medians():
    tree = turntrie.TernaryTree()
    for k in turntrie.medians(1023):
        tree.insert([k, 5], [1, 1])
    def height(at):
        return 0 if at < 0 else 1 + max(height(tree.low[at]), height(tree.high[at]))
    assert sorted(turntrie.medians(1023)) == list(range(1023)) and height(tree.same[0]) == 10


def mix_docs(spark):
    rows = [(k, prose(k, 1 + k * k % 90), f"s{k % 5}") for k in range(400)]
    rows += [(1000 + k, prose(1, 30), "big") for k in range(300)]
    rows += [(2000, prose(5, 4000), "big"), (None, prose(9, 10), None), (None, prose(9, 10), None), (None, prose(8, 7), None), (7, None, "s1"), (8, "", ""), (9, " \n", "empty")]
    rows += [(11, prose(2, 20), "s2"), (11, prose(2, 20), "s2"), (12, prose(3, 9), "")]
    return rows, spark.createDataFrame([(*r, "x", 1, "p", 3) for r in rows], DOCS).repartition(4)


def test_mix(spark):
    rows, docs = mix_docs(spark)
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = Counter()
    for (_, _, s), n in zip(rows, sizes, strict=True):
        total[s] += n
    names = sorted((s for s in total if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    budget, target, open_ones = 1.5 * sum(sizes), dict.fromkeys(names, 0.0), set(names)
    while open_ones:  # reshare until none is above twice its size
        left = budget - sum(v for s, v in target.items() if s not in open_ones)
        share = {s: left * weight[s] / sum(weight[o] for o in open_ones) for s in open_ones}
        above = {s for s in open_ones if share[s] > 2 * total[s]}
        target.update({s: 2.0 * total[s] for s in above} if above else share)
        open_ones = open_ones - above if above else set()
    plan = mixing.mix(docs)
    found = plan.rows().collect()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((i, n) for (i, _, _), n in zip(rows, sizes, strict=True))
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in found)
    spent = sum(r["taken"] for r in found)
    assert budget - max(sizes) <= spent <= budget
    by_source = {r["source"]: r["target"] for r in plan.sources.collect()}
    assert by_source.keys() == {mixing.NO_SOURCE if s is None else f"={s}" for s in names}
    for s in names:
        assert isclose(by_source[mixing.NO_SOURCE if s is None else f"={s}"], target[s], rel_tol=1e-9)
    taken = plan.queue.select("source", plan.taken().alias("n"), "size").groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("t")).collect()
    largest = {s: max(n for (_, _, o), n in zip(rows, sizes, strict=True) if o == s) for s in names}
    for r in taken:
        s = None if r["source"] == mixing.NO_SOURCE else r["source"][1:]
        assert abs(r["t"] - target[s]) <= largest[s] + max(sizes)
    order = lambda x: sorted(map(repr, x))
    again = mixing.mix(docs.repartition(7)).rows().collect()
    assert order((r["doc_id"], r["taken"]) for r in again) == order((r["doc_id"], r["taken"]) for r in found)
    copies = mixing.mixed(docs).select("copy", "row.*")
    assert copies.columns == ["copy", *docs.columns]
    assert copies.select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] == spent


def test_mix_with_other_shares_and_without_rows(spark):
    _, docs = mix_docs(spark)
    shares = mixing.Shares(weights=(1, 5), percent=300, times=2)
    assert all(r["taken"] == 2 * r["size"] for r in mixing.mix(docs, shares).rows().collect())
    assert mixing.mix(docs.limit(0)).rows().count() == 0
    assert mixing.mixed(docs.where("text is null")).count() == 0


def fails(text):
    words = WORD.findall(text)
    capitals = sum("A" <= c <= "Z" for c in text)
    return [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * len(text), bool(re.search(r"[#$%&*|]", text))]


def test_audit(spark):
    rows = [(k, prose(k % 30, 40 + k % 40) + (" #" if k % 7 == 0 else "") + (" ABCDEFGHIJKLMNOPQRSTUVWXYZ" if k % 5 == 0 else ""), f"s{k % 3}") for k in range(90)]
    rows += [(100 + k, "same " * 60, "hot") for k in range(60)]
    rows += [(None, None, None), (None, "", ""), (3, prose(3, 43), "s0"), (200, "", "hot"), (201, None, None), (202, "É" * 100 + " A|", "s1")]
    labels = [(k, 1 if k % 2 else 0, 1 if k % 4 == 0 else None) for k in range(0, 210, 3)] + [(6, 1, 1), (6, None, 0), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1, "p", 3) for r in rows], DOCS).repartition(5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    low = {}
    for i, t, _ in rows:
        t = t or ""
        low[t] = min(low.get(t, float("inf")), float("-inf") if i is None else i)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    facts = [((s or ""), [*fails(t or ""), (float("-inf") if i is None else i) > low[t or ""]], i in good, i in toxic) for i, t, s in rows]
    expected, shapley = {}, Counter()
    for part in {f[0] for f in facts}:
        for order in permutations(range(5)):
            left = [f for f in facts if f[0] == part]
            for step, own in enumerate(order):
                gone = [f for f in left if f[1][own]]
                every = [f for f in facts if f[0] == part and f[1][own]]
                left = [f for f in left if not f[1][own]]
                name = "".join("ABCDE"[k] for k in order)
                shapley[part, own] += len(gone)
                expected[part, name, step + 1] = [len(left), len(gone), len(every) - len(gone), sum(sum(f[1]) == 1 for f in every), sum(f[2] for f in gone), sum(f[3] for f in gone), own]
    found = filteraudit.filter_audit(docs, marks).collect()
    assert len(found) == len(expected) == 600 * 5
    for r in found:
        *counts, own = expected[r["part"], r["filter_order"], r["step"]]
        assert [*r[3:]] == [*counts, shapley[r["part"], own]]
    assert filteraudit.filter_audit(docs.limit(0), marks).count() == 0
    assert filteraudit.filter_audit(docs, marks.limit(0)).agg(F.sum("good_lost")).first()[0] == 0
