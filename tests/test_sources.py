"""Readers, writers, checkpoints and the streaming twin."""

import hashlib
import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalith.operators import monitor
from stratalith.sinks import checkpoints, manifests
from stratalith.sources import archives, catalogs, torrents, xml_docs
from stratalith.sources import manifests as manifest_source
from stratalith.streaming import monitor as streaming

SCHEMA = T.StructType([T.StructField("path", T.StringType(), False), T.StructField("size", T.LongType(), False), T.StructField("note", T.StringType())])


def write(folder, files):
    for name, data in files.items():
        (folder / name).write_bytes(data)


def test_manifest_round_trip_and_tampering(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2, None), ("a", 1, "é")], SCHEMA)
    seal = manifests.write_manifest(rows, f"{tmp_path}/m", order=["path"])
    assert seal["records"] == 2
    assert sorted(map(tuple, manifest_source.read_manifest(spark, f"{tmp_path}/m", SCHEMA).collect())) == [("a", 1, "é"), ("b", 2, None)]
    assert manifest_source.manifest_lines(spark, f"{tmp_path}/m", SCHEMA).count() == 0
    check = lambda **d: [r.error_code for r in manifest_source.verify_manifest(spark, f"{tmp_path}/m", **d).collect()]
    assert check(**seal) == []
    assert check(digest=seal["digest"], records=3) == ["record-count"]
    assert check(digest="0" * 64, records=2) == ["digest"]


def test_bad_lines(spark, tmp_path):
    lines = ['{"path":"a","size":1}', '{"size":1,"path":"a"}', "nonsense", '{"path":"a"}', '{"path":"a","size":1,"x":2}']
    (tmp_path / "m.jsonl").write_text("\n".join(lines) + "\n")
    found = {r.value: r.error_code for r in manifest_source.manifest_lines(spark, f"{tmp_path}/m.jsonl", SCHEMA).collect()}
    assert found == {lines[1]: "not-canonical", lines[2]: "not-json", lines[3]: "missing-field", lines[4]: "unknown-field"}


def test_sealing_and_blobs(spark, tmp_path):
    (tmp_path / "stage").mkdir()
    manifests.seal(spark, f"{tmp_path}/stage", f"{tmp_path}/final/one")
    assert (tmp_path / "final/one").is_dir()
    with pytest.raises(FileExistsError):
        manifests.seal(spark, f"{tmp_path}/final", f"{tmp_path}/final/one")
    blobs = spark.createDataFrame([(b"x",), (b"y",), (b"x",)], "content binary")
    assert manifests.put_blobs(blobs, f"{tmp_path}/store", content="content").count() == 2
    more = spark.createDataFrame([(b"y",), (b"z",)], "content binary")
    assert [r.digest for r in manifests.put_blobs(more, f"{tmp_path}/store", content="content").collect()] == [hashlib.sha256(b"z").hexdigest()]
    assert spark.read.parquet(f"{tmp_path}/store").count() == 3


def test_checkpoints_are_reused(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    one = checkpoints.stage_digest("s", 1, {"a": 1}, ["up"])
    assert one != checkpoints.stage_digest("s", 2, {"a": 1}, ["up"])
    assert checkpoints.checkpointed(spark, str(tmp_path), one, compute)[1] is False
    table, reused = checkpoints.checkpointed(spark, str(tmp_path), one, compute)
    assert reused and table.count() == 3 and len(calls) == 1
    (tmp_path / one / "_SUCCESS").unlink()
    assert checkpoints.checkpointed(spark, str(tmp_path), one, compute)[1] is False


def test_zip_listing(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a.txt", "hello")
        z.writestr("dir/", "")
    write(tmp_path, {"a.zip": data.getvalue(), "b.zip": b"broken", "c.txt": b"other"})
    found = archives.list_zips(archives.read_binaries(spark, str(tmp_path), "*.zip")).collect()
    assert sorted((r.name or "", r.size, r.is_folder, r.error_code is None) for r in found) == [("", None, None, False), ("a.txt", 5, False, True), ("dir/", 0, True, True)]


def bencode(v):
    if isinstance(v, int):
        return b"i%de" % v
    if isinstance(v, bytes):
        return b"%d:%s" % (len(v), v)
    if isinstance(v, list):
        return b"l" + b"".join(map(bencode, v)) + b"e"
    return b"d" + b"".join(bencode(k) + bencode(v[k]) for k in sorted(v)) + b"e"


def test_torrents(spark, tmp_path):
    info = {b"name": b"root", b"piece length": 10, b"pieces": b"x" * 40, b"files": [{b"length": 7, b"path": [b"a"]}, {b"length": 8, b"path": [b"d", b"b"]}]}
    bad = {**info, b"pieces": b"x" * 20}
    write(tmp_path, {"ok.torrent": bencode({b"info": info}), "bad.torrent": bencode({b"info": bad}), "odd.torrent": b"d4:infoi01ee", "cut.torrent": b"d4:info9:x"})
    found = torrents.list_torrents(archives.read_binaries(spark, str(tmp_path))).collect()
    good = sorted((r.name, r.size, r.info_hash) for r in found if not r.error_code)
    assert good == [("root/a", 7, hashlib.sha1(bencode(info)).hexdigest()), ("root/d/b", 8, hashlib.sha1(bencode(info)).hexdigest())]
    assert len([r for r in found if r.error_code]) == 3


def test_catalogs(spark, tmp_path):
    messages = {"": "header", "hello": "hallo", "menu\x04open": "öffnen", "one\0many": "eins\0viele"}
    data = catalogs.pack_catalog(messages)
    write(tmp_path, {"ok.mo": data, "bad.mo": data[:-9], "no.mo": b"nothing"})
    found = catalogs.list_messages(archives.read_binaries(spark, str(tmp_path))).collect()
    good = {(r.context, r.message_id, r.plural_id): r.texts for r in found if not r.error_code and r.path.endswith("ok.mo")}
    assert good == {(None, "", None): ["header"], (None, "hello", None): ["hallo"], ("menu", "open", None): ["öffnen"], (None, "one", "many"): ["eins", "viele"]}
    assert len([r for r in found if r.error_code]) == 2


def test_images(spark, tmp_path):
    head = b"MZ" + b"\0" * 58 + struct.pack("<I", 64)
    coff = b"PE\0\0" + struct.pack("<HHIIIHH", 0x8664, 1, 0, 0, 0, 2, 0) + struct.pack("<H", 0x20B)
    section = struct.pack("<8sIIII", b".text", 16, 4096, 512, 1024) + b"\0" * 12 + struct.pack("<I", 0x60000020)
    write(tmp_path, {"a.bin": head + coff + section + b"\0hello\0x\0world\0", "b.bin": b"ELF"})
    files = archives.read_binaries(spark, str(tmp_path))
    good = [r for r in archives.list_pe_sections(files).collect() if not r.error_code]
    assert [(r.name, r.address, r.file_offset, r.executable) for r in good] == [(".text", 4096, 1024, True)]
    texts = {r.text for r in archives.list_strings(files).collect()}
    assert {"hello", "world"} <= texts and "x" not in texts


def test_xml(spark):
    good = "<r><f n='a'><size>1</size></f><f n='b'><size>2</size></f><v/><w>7</w></r>"
    evil = "<!DOCTYPE r [<!ENTITY e 'boom'>]><r><f n='&e;'/></r>"
    docs = spark.createDataFrame([(1, good), (2, evil), (3, "<r/>"), (4, None)], "id int, xml string")
    found = xml_docs.explode_nodes(docs, xml="xml", keep=["id"], node="/r/f", fields={"name": "@n", "size": "size"})
    assert sorted((r.id, r.position, r.name, r["size"]) for r in found.collect()) == [(1, 1, "a", "1"), (1, 2, "b", "2")]
    assert [r.s for r in docs.orderBy("id").select(xml_docs.xml_status(F.col("xml")).alias("s")).collect()] == ["ok", "refused", "ok", "refused"]
    assert docs.where("id = 1").select(xml_docs.first_present(F.col("xml"), ["/r/v", "/r/w"]).alias("x")).first().x == "7"


def test_stream_is_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    samples = events.selectExpr("event_id", "user_id", "CAST(CAST(ts AS TIMESTAMP) AS BIGINT) AS t", "CAST(round(value * 100) AS BIGINT) AS cents")
    want = monitor.idle_gaps(samples, key="user_id", time=F.col("t"), tie="event_id", amount=F.col("cents"))
    middle = samples.approxQuantile("t", [0.5], 0.0)[0]
    for k, part in enumerate((samples.where(F.col("t") <= middle), samples.where(F.col("t") > middle))):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(streaming.SAMPLE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{tmp_path}/in")
    query = streaming.idle_stream(stream).writeStream.format("memory").queryName("idle").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = spark.sql("SELECT event_id, idle_seconds FROM idle")
    assert sorted(map(tuple, got.collect())) == sorted((r.event_id, r.idle_seconds) for r in want.collect())


def test_stream_lets_go_of_silent_keys(spark, tmp_path):
    """A key that is silent for longer than it is kept leaves the store, and begins anew."""
    parts = [[(1, 1, 90_000, 5), (2, 1, 90_100, 5)], [(3, 2, 100_000, 1)], [(4, 2, 100_900, 1)], [(5, 1, 100_901, 5)]]
    for k, part in enumerate(parts):
        spark.createDataFrame(part, streaming.SAMPLE).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(streaming.SAMPLE).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{tmp_path}/in")
    kept = streaming.idle_stream(stream, late="1 second", keep_seconds=1_000)
    query = kept.writeStream.format("memory").queryName("kept").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert dict(map(tuple, spark.sql("SELECT event_id, idle_seconds FROM kept").collect())) == {1: 0, 2: 100, 3: 0, 4: 900, 5: 0}


def test_windowed_counts(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(f"{tmp_path}/in")
    counts = streaming.windowed_counts(stream, time="ts", kind="event_type", width="1 day", late="1 hour")
    query = counts.writeStream.format("memory").queryName("counts").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    got = spark.sql("SELECT sum(n) AS n, count(DISTINCT window_start) AS w FROM counts").first()
    assert 0 < got.n < 1000 and got.w >= 25


@pytest.mark.parametrize("part_lines", [200_000, 7])
def test_manifest_digest_is_that_of_the_files(spark, tmp_path, part_lines):
    table = spark.range(40).selectExpr("CAST(id AS STRING) AS path", "CAST(id AS INT) AS size", "CAST(NULL AS STRING) AS note").repartition(3)
    seal = manifests.write_manifest(table.coalesce(1), f"{tmp_path}/m", order=["size"], part_lines=part_lines)
    files = [p.read_bytes() for p in sorted((tmp_path / "m").glob("part-*.txt"))]
    assert [json.loads(line)["size"] for data in files for line in data.splitlines()] == list(range(40))
    held = [(hashlib.sha256(d).hexdigest(), d.count(b"\n")) for d in files if d]
    want = held[0][0] if len(held) == 1 else hashlib.sha256("".join(f"{h} {n}\n" for h, n in held).encode()).hexdigest()
    assert seal == {"records": 40, "digest": want}
    last = sorted((tmp_path / "m").glob("part-*.txt"))[-1]
    last.write_bytes(last.read_bytes()[:-1])
    (tmp_path / "m" / f".{last.name}.crc").unlink()
    assert {r.error_code for r in manifest_source.verify_manifest(spark, f"{tmp_path}/m", **seal).collect()} == {"digest", "record-count", "open-line"}


def test_sealed_folders_are_checked(spark, tmp_path):
    name = manifests.write_seal(spark, f"{tmp_path}/s", {"files": {"records": 2, "sha256": "x"}, "created_at": "2024"})
    assert manifests.write_seal(spark, f"{tmp_path}/t", {"files": {"sha256": "x", "records": 2}, "created_at": "2025"}) == name
    assert manifests.seal_errors(spark, f"{tmp_path}/s").collect() == []
    path = tmp_path / "s" / "snapshot.json"
    path.write_bytes(path.read_bytes().replace(b'"x"', b'"y"'))
    (tmp_path / "s" / ".snapshot.json.crc").unlink()
    assert {r.error_code for r in manifests.seal_errors(spark, f"{tmp_path}/s").collect()} == {"ready", "identity"}


def test_xml_nodes_that_lack_a_field(spark):
    xml = "<r><g><f n='a'><size>1</size></f><f><size></size></f><f n='c'/></g></r>"
    docs = spark.createDataFrame([(1, xml), (2, "<r/>"), (3, "<r><g>")], "id int, xml string")
    found = xml_docs.explode_nodes(docs, xml="xml", keep=["id"], node="/r/g/f", fields={"name": "@n", "size": "size"})
    assert sorted(map(tuple, found.collect())) == [(1, 1, "a", "1"), (1, 2, None, None), (1, 3, "c", None)]


def test_files_come_in_bounded_batches(spark):
    """Files are read in batches of bounded bytes, so a worker's memory does not follow how many or how long they are."""
    from stratalith.sources import archives, catalogs

    rows = [(str(k), bytearray(catalogs.pack_catalog({"": "", f"m{k}": "x" * 1_500_000}))) for k in range(8)]
    files = spark.createDataFrame(rows, "path string, content binary").coalesce(1)
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    found = catalogs.list_messages(files).where("message_id <> ''")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) == archives.BATCH_BYTES
    assert found.selectExpr("count(*) AS n", "min(length(texts[0])) AS m").first() == (8, 1_500_000)
