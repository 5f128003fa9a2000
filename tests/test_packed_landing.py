"""Packed deliveries and coverage state by groups of ids."""
import datetime as dt

from pyspark.sql import functions as F

from covlens.functions.text import WS_RUN_RE, clean_text
from covlens.sources import landing as L
from covlens.streaming import ingest as S

RUN_AT = "2024-01-31 00:00:00"
FEED = "<rss version='2.0'><channel><title>x</title><item><title>café {0}</title><link>https://f.example.net/{0}</link></item></channel></rss>"
DOCS = ([(f"doc=gdelt__{i}.json", f'[{{"url": "https://a.example.net/{i}", "title": "t{i}"}}]'.encode()) for i in range(12)]
        + [(f"doc=rss__s-{i}.xml", FEED.format(i).encode("utf-16" if i % 2 else "utf-8")) for i in range(12)]
        + [("doc=mediastack__errors-1.json", b'{"error": {"code": "rate", "message": "m"}}'), ("doc=gdelt__bad.json", b"{")])


def ingested(spark, base, packed):
    registry = spark.createDataFrame([("rss", "s", "Named", "u", None)], "platform string, key string, name string, url string, channel_id string")
    S.run_ingest_stream(spark, f"{base}/landing", f"{base}/log", f"{base}/snap", f"{base}/ck", F.lit(RUN_AT), side=f"{base}/side",
                        registry=registry, packed=packed)
    doc = F.regexp_extract("seq.file", "(doc=[^/]+)/", 1)
    log = spark.read.parquet(f"{base}/log").select("batch_id", doc, "seq.pos", "id", "title", "publisher_or_author", "signals_json", "raw_json")
    errors = spark.read.parquet(f"{base}/side/errors").select(F.regexp_extract("path", "(doc=[^/]+)/", 1), "code", "message")
    return sorted(log.collect()), sorted(errors.collect())


def test_packed_documents_give_the_rows_of_single_files(spark, tmp_path):
    for name, content in DOCS:
        (tmp_path / "single" / "landing" / name).mkdir(parents=True)
        (tmp_path / "single" / "landing" / name / "part-0").write_bytes(content)
    frame = spark.createDataFrame([(f"delivery=0/{n}/", bytearray(c)) for n, c in DOCS], L.PACKED_SCHEMA)
    L.pack_documents(frame, f"{tmp_path}/packed/landing")
    single, packed = ingested(spark, tmp_path / "single", False), ingested(spark, tmp_path / "packed", True)
    assert single == packed and len(packed[0]) == 24 and len(packed[1]) == 1
    assert len(list((tmp_path / "packed" / "landing").glob("part-*"))) < len(DOCS)


def test_a_group_of_ids_keeps_each_id_for_itself(spark, tmp_path):
    """Ids that share a group: first sightings, a correction, and a horizon of their own."""
    log_type = ("id string, title string, summary string, platform string, published_at timestamp, ingested_at timestamp, "
                "seq struct<batch: bigint, src: int, file: string, pos: bigint>, batch_id bigint")

    def row(i, day, batch, ingested):
        return (f"i{i}", "t", None, "rss", dt.datetime(2024, 1, day), ingested, (batch, 0, "a", i), batch)
    feb, mar, may = dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 20), dt.datetime(2024, 5, 20)
    first = [row(i, 5, 5, feb) for i in range(6)] + [row(0, 6, 6, feb)]
    deliveries = [first, [row(1, 3, 1, mar), row(9, 9, 7, mar)], [row(9, 2, 8, may)],
                  [row(2, 8, 9, may), row(9, 1, 0, may)]]
    got = []
    for k, rows in enumerate(deliveries):
        spark.createDataFrame(rows, log_type).repartition(2).write.mode("append").parquet(f"{tmp_path}/log")
        stream = S.coverage_increments(spark.readStream.schema(log_type).parquet(f"{tmp_path}/log"), groups=2)

        def keep(df, batch_id):
            got.extend((k, r.id, r.day[-2:], r.n) for r in df.collect())
        (stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{tmp_path}/ck")
         .trigger(availableNow=True).start().awaitTermination())
    assert sorted(got) == sorted([(0, f"i{i}", "05", 1) for i in range(6)]
                                 + [(1, "i1", "05", -1), (1, "i1", "03", 1), (1, "i9", "09", 1)]
                                 # i2 was not seen for the horizon and counts anew; i9 was
                                 + [(3, "i2", "08", 1), (3, "i9", "09", -1), (3, "i9", "01", 1)])


def test_whitespace_runs_of_every_kind_become_one_space(spark):
    odd = [chr(n) for n in range(0x3100) if chr(n).isspace()]
    texts = ["a" + c + "b" for c in odd] + ["a " + c + "b" for c in odd] + ["a" + c + " b" for c in odd] + ["a  b", "a b", "​z", "é é", "~\t!"]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", clean_text(F.col("t")).alias("t")).collect()
    assert {r.k: r.t for r in rows} == {k: " ".join(t.split()) for k, t in enumerate(texts)}
    # single spaces are left where they are, not matched and replaced one by one
    assert spark.range(1).select(F.lit("one word and another").rlike(WS_RUN_RE)).first()[0] is False
