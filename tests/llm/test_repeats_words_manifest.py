"""Suffix-array repetition, spelling variants and the Merkle manifest against brute force, and on hostile rows."""
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from covlens.llm import merkle, repetition, spelling

# --- repetition ------------------------------------------------------------------------------------------------------

WORD = r"[^\x20\x09-\x0D]+"


def plain_counts(t, k=repetition.SHORTEST):
    words = re.findall(WORD, t or "")
    n = len(words)

    def repeated(width):
        seen = collections.Counter(tuple(words[i:i + width]) for i in range(n - width + 1))
        return [i for i in range(n - width + 1) if seen[tuple(words[i:i + width])] > 1]

    three, covered, longest = set(), set(), 0
    for i in repeated(3):
        three.update(range(i, i + 3))
    for width in range(k, n):
        at = repeated(width)
        if not at:
            break
        longest = width
        for i in at:
            covered.update(range(i, i + width))
    lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
    return [n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(three), len(covered),
            longest]


def some_texts():
    rng = random.Random(1)
    out = [None, "", " \n\t", "a " * 60, "é# " * 7 + "x", "A a A a A a", "x\x0cy\x1cz 1 2 3 x\x0cy\x1cz 1 2 3"]
    for _ in range(200):
        words = [chr(97 + i % 26) * (1 + i // 26) + "é" for i in range(rng.choice([2, 3, 10, 200]))]
        t = [rng.choice(words) for _ in range(rng.randrange(80))]
        if rng.random() < 0.5 and len(t) > 12:
            t += t[3:12 + rng.randrange(20)]
        out.append("".join(w + rng.choice([" ", " ", "\n"]) for w in t))
    return out


def test_repetition_counts_equal_brute_force():
    texts = some_texts()
    assert np.array(repetition.measure(pa.array(texts))).T.tolist() == [plain_counts(t) for t in texts]
    assert [len(c) for c in repetition.measure(pa.array([], pa.string()))] == [0] * 7


def test_repetition_verdicts_on_hostile_rows(spark):
    rng = random.Random(2)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage, line = fresh(51), fresh(8)
    texts = {0: fresh(300), 1: f"{fresh(200)} {passage} {fresh(50)} {passage}", 2: "word " * 300_000, 3: None, 4: "", 5: fresh(49),
             6: "\n".join([fresh(30), line, fresh(30), line]), 7: "\n".join([line] * 6 + [fresh(70)]),
             8: f"{fresh(600)} {' '.join(passage.split()[:50])} {fresh(50)} {' '.join(passage.split()[:50])}"}
    docs = spark.createDataFrame([(i, t, "k", "n", "b") for i, t in texts.items()] + [(0, texts[0], "k", "n", "b"), (None, texts[1], "k", "n", "b")],
                                 "doc_id bigint, text string, kept string, n_words string, `a b` string")
    got = repetition.judge(docs).collect()
    assert len(got) == 11 and got[0]["a b"] == "b"
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert {i for i, k in kept.items() if k} == {0, 6, 8}
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["longest_repeat"] == 51 and by_id[8]["longest_repeat"] == 50 and not by_id[1]["base_failed"]
    assert (by_id[2]["n_covered"], by_id[2]["longest_repeat"]) == (300_000, 299_999)
    assert by_id[7]["n_covered"] == 48 and not by_id[7]["base_failed"]
    assert repetition.judge(docs.limit(0)).count() == 0


# --- spelling --------------------------------------------------------------------------------------------------------

def one_error(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] or a[i:] == b[i + 1:] or a[i + 1:] == b[i:]


def plain_words(rows):
    out = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 6:
                out[run] += 1
    return out


def plain_variants(rows):
    n = {w: k for w, k in plain_words(rows).items() if k >= 5}
    near = {w: [v for v in n if one_error(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-n[v], v))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return out


def random_words(rng, k, alphabet="abcé"):
    out = {"x" * 300, "x" * 301, "x" * 299 + "y"}
    while len(out) < k:
        out.add("".join(rng.choice(alphabet) for _ in range(rng.randrange(6, 10))))
    return sorted(out)


@pytest.mark.parametrize("side", [0, 1])
def test_each_search_finds_what_its_half_leaves_open(side):
    words = random_words(random.Random(3), 700)
    cell = spelling._Cell(side)
    cell.add(words, [1] * len(words))
    got = {(i, k) for i, k in zip(*(x.tolist() for x in cell.search(words))) if i != k}
    want = set()
    for (i, w), (k, v) in itertools.permutations(enumerate(words), 2):
        p = len(w) // 2
        if one_error(w, v) and (w[:p] == v[:p] if side == 0 else w[p:] == v[len(v) - (len(w) - p):]):
            want.add((i, k))
    assert got == want


def test_runs_and_counts_equal_brute_force():
    rng = random.Random(4)
    words = random_words(rng, 80, "abcdEFG×ÿ")
    texts = ["Héllo wörldly ABCDEF×÷ x", "", None, "a" * 5000 + " " + "a" * 5000]
    texts += [" ".join(rng.choice(words) + rng.choice(["", ",", "1", "Ā"]) for _ in range(400)) for _ in range(20)]
    ids = [None, *range(len(texts) - 1)]
    got = collections.Counter()
    for w, k in zip(*spelling.slice_words(pa.array(texts), ids)):
        got[w] += k
    assert got == plain_words(zip(ids, texts))


@pytest.mark.parametrize("cell_words", [spelling.CELL_WORDS, 7])
def test_variants_equal_brute_force(spark, cell_words):
    rng = random.Random(5)
    words = random_words(rng, 90, "abé")
    weights = [rng.choice([1, 2, 9, 60, 400]) for _ in words]
    rows = [(rng.choice([None, i]), " ".join(rng.choices(words, weights, k=300))) for i in range(40)]
    rows += [(1, None), (2, ""), (3, "Abbabab " * 3000), (3, "Abbabab " * 3000), (4, "zzzzzz " * 5)]
    rows += [(5, "qqqqqq " * 6), (6, "qqqqqs " * 40), (7, "qqqqts " * 300)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id bigint, text string, n string")
    got = [tuple(r) for r in spelling.variants(docs, cell_words=cell_words).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants(rows)
    assert any(r[1] for r in got) and any(r[1] != r[2] for r in got if r[1])


def test_variants_of_nothing(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string")
    assert spelling.variants(docs).count() == 0 and spelling.variants(docs.limit(0)).count() == 0


# --- manifest --------------------------------------------------------------------------------------------------------

def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])

    def path(i):
        out = []
        for level in levels[:-1]:
            f = i - i % 8
            out.append(("".join(level[f:i]), "".join(level[i + 1:f + 8])))
            i //= 8
        return out
    return levels[-1][0], path


def plain_manifest(rows):
    leaf = lambda r: H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])
    lower = lambda t: None if t is None else re.sub("[A-Z]", lambda m: m[0].lower(), t)
    leaves = []
    for r in rows:
        tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        leaves.append((r[2], r[0], leaf(r), leaf((*r[:4], lower(r[4]))) if tampered else leaf(r)))
    leaves.sort(key=lambda x: (x[0] is not None, (x[0] or "").encode(), x[1] is not None, x[1] or 0, x[2]))
    groups = [list(v) for _, v in itertools.groupby(leaves, key=lambda x: x[0])]
    if not groups:
        return []
    trees = [plain_tree([x[2] for x in v]) for v in groups]
    root, above = plain_tree([t[0] for t in trees])
    out = []
    for g, v in enumerate(groups):
        for i, (_, key, node, now) in enumerate(v):
            path = trees[g][1](i) + above(g)
            for b, a in path:
                now = H(b, now, a)
            out.append((key, node, trees[g][0], root, H(*[b + a for b, a in path]), now, now == root))
    return out


def hostile_documents():
    rng = random.Random(5)
    rows = [(rng.choice([rng.randrange(-10**6, 10**6), rng.randrange(-2**63, 2**63), rng.randrange(3000)]), rng.choice(["s", None]),
             rng.choice(["en"] * 9 + ["de", "é", "", "zz", None]), rng.choice([1, None]),
             rng.choice(["Hello", "x" * 10, "", None, "é A"])) for _ in range(1300)]
    rows += [(None, "a", "en", 1, "q")] * 3 + [(None, "b", None, 1, "q")] + [(7, "a", "en", 1, "Same")] * 600
    rows += [(8, "a", "en", 1, f"t{i}") for i in range(300)] + [(i, None, f"l{i}", 1, "T") for i in range(20)]
    return rows + [(9, "s", "en", 1, "Long " * 200_000)]


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 3, "Abc")], [(i, "a", None, 3, "Abc") for i in range(9)], hostile_documents()],
                         ids=["empty", "one", "nine", "hostile"])
def test_manifest_equals_brute_force(spark, rows):
    clash = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree string, n string, idx string"
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], clash).repartition(3)
    key = lambda t: tuple(map(str, t))
    assert sorted((tuple(r) for r in merkle.manifest(docs).collect()), key=key) == sorted(plain_manifest(rows), key=key)


def test_directory_ranks_sparse_ids_without_a_sort_of_the_rows(spark):
    rng = random.Random(6)
    ids = sorted({rng.randrange(-2**63, 2**63) for _ in range(500)} | {*range(-70, 70)})
    rows = merkle.directory(spark.createDataFrame([("=t", i) for i in ids], "tree string, id bigint"))
    got = {r["word"]: (r["before"], r["n"]) for r in rows.collect()}
    for rank, i in enumerate(ids):
        before, n = got[i >> 6]
        assert before <= rank < before + n
