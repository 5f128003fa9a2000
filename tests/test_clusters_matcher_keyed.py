"""Duplicate clusters, the automaton tagger and snapshots bucketed by id."""
import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from covlens.config import Taxonomy, Topic
from covlens.operators import store as ST
from covlens.operators import tagging as T
from covlens.operators.clusters import components, duplicate_clusters
from covlens.plans.queries_streaming import _Run
from covlens.streaming import ingest as S

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", ["duplicate_clusters", "keyword_enrich_table", "stream_upsert_keyed"])
def test_oracle_agrees(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    rel = con.execute(E.oracle_sql()[name])
    dc = [d[0] for d in rel.description]
    assert sorted(dc) == cols
    want = sorted(repr(tuple(dict(zip(dc, r))[c] for c in cols)) for r in rel.fetchall())
    assert want and sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == want


# --- clusters -------------------------------------------------------------
def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {frozenset(y for y in root if find(y) == r) for r in map(find, list(root))}


def classes(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["root"], set()).add(r["node"])
    return set(map(frozenset, out.values()))


CHAIN = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(200)]
RNG = random.Random(4)
RANDOM = [(f"u{RNG.randrange(150)}", f"h{RNG.randrange(150)}") for _ in range(120)]
HUB = [("hub", f"x{i}") for i in range(300)] + [("y", "x7"), ("z", "z")]


@pytest.mark.parametrize("links", [CHAIN, RANDOM, HUB + RANDOM, [("a", "a")]])
def test_components_equal_union_find(spark, links):
    got = components(spark.createDataFrame(links + links[:3], "a string, b string").repartition(5))
    assert got.count() == len({x for link in links for x in link})
    assert classes(got) == brute(links)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([(None, "a"), ("b", None)], "a string, b string")).count() == 0


def test_url_and_hash_groups_are_one_group(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    rows = [("a", "p", at(3), "u1", "h1"), ("b", "q", at(2), "u1", "h2"), ("c", "p", at(9), "u9", "h2"),  # a-b by url, b-c by hash
            ("d", "p", at(1), "", "h1"), ("e", "p", at(5), "", ""), ("f", "p", at(5), None, None),
            ("g", "r", at(5), "u7", None), ("h", "r", at(5), "u7", ""), ("i", "r", None, "h2", None)]  # a url that reads like a hash
    items = spark.createDataFrame(rows, "id string, platform string, ingested_at timestamp, url string, content_hash string")
    got = {r.id: (r.keep_id, r.kept, r.n_items, r.n_platforms) for r in duplicate_clusters(items).collect()}
    big = {i: ("d", i == "d", 4, 2) for i in "abcd"}
    assert got == {**big, "e": ("e", True, 1, 1), "f": ("f", True, 1, 1), "g": ("g", True, 2, 1), "h": ("g", False, 2, 1),
                   "i": ("i", True, 1, 1)}
    assert duplicate_clusters(items.limit(0)).count() == 0


# --- tagging by automaton ---------------------------------------------------
def taxonomy_of(rng, n):
    word = lambda: "".join(rng.choice("ab Yé") for _ in range(rng.randrange(1, 5)))
    topics = [Topic(f"t{i}", "", tuple(word() for _ in range(rng.randrange(4))), tuple(word() for _ in range(rng.randrange(2))))
              for i in range(n)]
    return Taxonomy((*topics, Topic("open"), Topic("void", "", ("",)), Topic("where", "", (), ("b a",))), ("Ab", "zz", "Ab", "y"))


def test_automaton_equals_the_native_chain(spark):
    rng = random.Random(11)
    tx = taxonomy_of(rng, 40)
    texts = ["".join(rng.choice("ab yé") for _ in range(rng.randrange(30))) for _ in range(200)] + ["", None, "ab" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(3)
    native = df.select("n", T.keyword_topics(F.col("text"), tx).alias("topics"), T.keyword_actors(F.col("text"), tx).alias("actors"))
    one_pass = df.select("n", T.keyword_tags(F.col("text"), tx).alias("t")).select("n", "t.*")
    assert sorted(native.collect()) == sorted(one_pass.collect())
    assert T.keyword_tags(F.lit("x"), Taxonomy()) is not None
    assert df.select(T.keyword_tags(F.col("text"), Taxonomy()).alias("t")).filter("size(t.topics) + size(t.actors) > 0").count() == 0


def test_five_thousand_words_are_one_pass(spark):
    words = spark.range(5000).select(F.col("id").alias("place"), F.concat(F.lit("t"), F.col("id") % 700).alias("topic"),
                                     F.lit("keyword").alias("kind"), F.sha2(F.col("id").cast("string"), 256).substr(1, 4).alias("word"))
    tx = Taxonomy.from_frame(words.unionByName(words))  # repeated rows count once
    assert len(tx.topics) == 700 and T.n_words(tx) > T.AUTOMATON_FROM
    items = spark.range(50).select(F.col("id").cast("string"), F.sha2(F.concat(F.lit("x"), "id"), 512).alias("title"),
                                   F.lit(None).cast("string").alias("summary"))
    got = T.keyword_enrich(items, tx)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [tag(") == 1 and len(plan) < 20_000
    hits = items.crossJoin(words).filter(F.col("title").contains(F.col("word"))).select("id", "topic").distinct()
    assert (sorted((r.id, r.topic) for r in hits.collect())
            == sorted((r.id, t) for r in got.collect() for t in r.topics))


def test_taxonomy_table_beyond_its_bound_is_an_error(spark):
    words = spark.createDataFrame([(1, "t", "keyword", "a"), (2, "t", "location", "b"), (3, None, "actor", "C"), (4, "t", "keyword", None)],
                                  "place int, topic string, kind string, word string")
    assert Taxonomy.from_frame(words) == Taxonomy((Topic("t", "", ("a",), ("b",)),), ("C",))
    assert Taxonomy.from_frame(words.limit(0)) == Taxonomy()
    with pytest.raises(ValueError, match="a taxonomy of 3 words"):
        Taxonomy.from_frame(words, max_words=2)


# --- snapshots bucketed by id -------------------------------------------------
@pytest.fixture(scope="module")
def keyed(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _Run(spark, SMALL, compact_every=1, buckets=8)


def test_keyed_snapshot_and_log_equal_the_fold(spark, keyed):
    whole = ST.upsert_fold(spark.read.parquet(keyed.log))
    items = S.read_items(spark, keyed.log, keyed.snap)
    whole = whole.select(*items.columns)
    assert items.count() > 0 and items.exceptAll(whole).count() == 0 and whole.exceptAll(items).count() == 0


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def below(plan: str, scan: str):
    """The operators between a scan of the tree and the first join above it."""
    lines = plan.splitlines()
    for n, line in enumerate(lines):
        if scan in line:
            depth, path = len(line) - len(line.lstrip(" :+-*()0123456789")), []
            for up in reversed(lines[:n]):
                d = len(up) - len(up.lstrip(" :+-*()0123456789"))
                if d < depth:
                    depth = d
                    path.append(up)
                    if "Join" in up:
                        break
            yield path


def test_the_history_is_not_shuffled(spark, keyed, no_broadcast):
    version, buckets = S._newest(spark, keyed.snap)
    held = ST.read_keyed_snapshot(spark, S.snapshot_path(keyed.snap, version, buckets), buckets)
    new, stats = ST.upsert_batch(held, spark.read.parquet(keyed.log).filter("batch_id = 1"))
    for df in (new, stats):
        plan = df._jdf.queryExecution().executedPlan().toString()
        paths = list(below(plan, "Bucketed: true"))
        assert paths and not any("Exchange" in op for path in paths for op in path), plan
    assert stats.first().asDict()["inserted"] == 0


def test_another_session_reads_the_buckets(spark, keyed):
    version, buckets = S._newest(spark, keyed.snap)
    path = S.snapshot_path(keyed.snap, version, buckets)
    want = ST.read_keyed_snapshot(spark, path, buckets)
    rows = want.count()
    spark.sql(f"DROP TABLE {ST._keyed_table(path)}")  # a catalog that knows nothing of it; the files stay
    again = ST.read_keyed_snapshot(spark, path, buckets)
    assert again.count() == rows and again.filter(F.col("id") == want.first().id).count() == 1


def test_versions_of_both_layouts_follow_each_other(spark, keyed, tmpdir_path):
    snap = f"{tmpdir_path}/snapshot"
    log = spark.read.parquet(keyed.log)
    first = ST.upsert_fold(log.filter("batch_id = 0"))
    ST.write_snapshot(first.select(*[c for c in first.columns if c in ST.ITEM_COLUMNS]), S.snapshot_path(snap, 0))
    dated = S.read_items(spark, keyed.log, snap)
    ST.write_keyed_snapshot(dated, S.snapshot_path(snap, 1, 4), 4)
    assert S._newest(spark, snap) == (1, 4) and S.latest_snapshot(spark, snap) == 1
    whole = ST.upsert_fold(log)
    items = S.read_items(spark, keyed.log, snap)
    whole = whole.select(*items.columns)
    assert items.exceptAll(whole).count() == 0 and whole.exceptAll(items).count() == 0
