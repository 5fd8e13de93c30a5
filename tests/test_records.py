from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from topicloom.sources import centroid_files, records, tables
from topicloom.streaming.ingest import ingest

HEAD = ('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
        'xmlns:{dc}="http://purl.org/dc/elements/1.1/" '
        'xmlns:cinii="https://cir.nii.ac.jp/schema/1.0/">')


def record(body: str, dc: str = "dc") -> str:
    return HEAD.format(dc=dc) + body + "</rdf:RDF>"


NOTE = "<cinii:description><cinii:notation>{}</cinii:notation></cinii:description>"
CASES = [
    (record("<dc:title xml:lang='en'>E</dc:title><x><dc:title>J</dc:title></x>"), "J", None),
    (record("<dc:title xml:lang='en'>E</dc:title><dc:title xml:lang='en'>F</dc:title>"), "E", None),
    (record("<dc:title xml:lang='ja'>A</dc:title><dc:title>B</dc:title>"), "A", None),
    (record("<dc:title xml:lang='en'>E</dc:title><dc:title/>"), None, None),
    (record(NOTE.format(" \u3000a &amp; b\n ")), None, "a & b"),
    (record(NOTE.format("first") + NOTE.format("second")), None, "first"),
    (record(NOTE.format("")), None, None),
    (record("<cinii:notation>elsewhere</cinii:notation>"), None, None),
    (record("<d:title>own prefix</d:title>", dc="d"), "own prefix", None),
    ("<rdf:RDF><open>", None, None),
    (None, None, None),
    (record("<d:title>t</d:title>" + NOTE.format("see d:foo"), dc="d"), "t", "see d:foo"),
    (record('<title xmlns="http://purl.org/dc/elements/1.1/">bare</title>'), "bare", None),
    ('<RDF xmlns="http://purl.org/dc/elements/1.1/"><title>root</title></RDF>', "root", None),
]


def test_extract_record(spark):
    df = spark.createDataFrame([(str(n), xml) for n, (xml, _, _) in enumerate(CASES)],
                               "file string, xml string")
    got = {int(r["file"]): r for r in records.extract_record(df, "file", "xml").collect()}
    for n, (xml, title, abstract) in enumerate(CASES):
        assert (got[n]["title"], got[n]["abstract"]) == (title, abstract), xml
    assert got[9]["corrupt"] and not any(got[n]["corrupt"] for n in range(9))


PIECES = [
    (record("<dc:title>a<![CDATA[b]]></dc:title>" + NOTE.format("<![CDATA[]]> x")), "a", ""),
    (record("<dc:title><!-- c -->a<!-- d -->b</dc:title>" + NOTE.format("y<?p?>z")), "a", "y"),
    (record("<dc:title xml:lang='en'>E</dc:title><dc:title><b>x</b></dc:title>"
            + NOTE.format("\u00a0&lt;!&#xe000;\u3000")), None, "<!\ue000"),
    (record("<dc:title xml:lang='en'/><dc:title xml:lang='en'>F</dc:title>"
            + NOTE.format(" \n ")), None, ""),
    (record('<x xmlns:other="http://purl.org/dc/elements/1.1/"><other:title>o</other:title></x>'
            + NOTE.format("xmlns:q=")), None, "xmlns:q="),
    (record('<x xmlns:other = "http://purl.org/dc/elements/1.1/"/><dc:title>p</dc:title>'),
     "p", None),
]


def test_one_xpath_reads_a_record(spark):
    """Every XPath parses its text again, so one reads what no CDATA or comment cuts."""
    df = spark.createDataFrame([(str(n), xml) for n, (xml, _, _) in enumerate(PIECES)],
                               "file string, xml string")
    found = records.extract_record(df, "file", "xml")
    got = {int(r["file"]): (r["title"], r["abstract"]) for r in found.collect()}
    assert got == {n: (title, abstract) for n, (_, title, abstract) in enumerate(PIECES)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" AS _found#") == 1


@pytest.fixture
def folder(tmp_path):
    for n in range(7):
        place = tmp_path / "raw" / f"d{n % 3}"
        place.mkdir(parents=True, exist_ok=True)
        (place / f"r{n}.rdf").write_text(record(f"<dc:title>t{n}</dc:title>"), encoding="utf-8")
    (tmp_path / "raw" / "note.txt").write_text("not a record")
    return tmp_path


def test_scan_and_sample(spark, folder):
    found = records.scan_records(spark, str(folder / "raw"))
    assert {r["title"] for r in found.collect()} == {f"t{n}" for n in range(7)}
    few = records.scan_records(spark, str(folder / "raw"), max_files=3)
    assert few.count() == 3
    again = records.scan_records(spark, str(folder / "raw"), max_files=3)
    assert {r["title"] for r in few.collect()} == {r["title"] for r in again.collect()}


def test_archives(spark, tmp_path):
    body = "\n".join(record(f"<dc:title>t{n}</dc:title>") for n in range(5)) + "\n"
    (tmp_path / "all.rdf").write_text(body)
    found = records.scan_records(spark, str(tmp_path), record_end=records.RECORD_END)
    assert {r["title"] for r in found.collect()} == {f"t{n}" for n in range(5)}


def test_ingest_resumes(spark, folder):
    out, state = str(folder / "out"), str(folder / "state")
    root = str(folder / "raw")
    assert ingest(spark, root, out, state, files_per_batch=3) == [3, 3, 1]
    assert spark.read.parquet(out).count() == 7
    assert ingest(spark, root, out, state, files_per_batch=3) == []
    assert spark.read.parquet(out).count() == 7
    (folder / "raw" / "late.rdf").write_text(record("<dc:title>late</dc:title>"))
    ingest(spark, root, out, state, files_per_batch=3)
    titles = [r["title"] for r in spark.read.parquet(out).collect()]
    assert sorted(titles) == sorted([f"t{n}" for n in range(7)] + ["late"])


def test_csv_keeps_everything(spark):
    rows = [("a", 'say "hi"', "two\nlines"), ("b", None, ""), ("c", "NA", "back\\slash, comma"),
            ("d", " spaces ", "\u3000")]
    df = spark.createDataFrame(rows, tables.DOCUMENT_SCHEMA)
    back = {r["file"]: tuple(r) for r in tables.roundtrip_csv(df).collect()}
    assert back["a"] == rows[0] and back["c"] == rows[2] and back["d"] == rows[3]
    assert back["b"][1] is None


def test_null_tokens(spark, tmp_path):
    df = spark.createDataFrame([("a", "NA", "x")], tables.DOCUMENT_SCHEMA)
    tables.write_csv(df, str(tmp_path / "csv"))
    read = tables.read_csv(spark, str(tmp_path / "csv"), null_tokens=["NA"])
    assert read.first()["title"] is None


def test_single_files_of_centroids(spark, tmp_path):
    """Files as other tools write them: rows without ids, one indented object."""
    import gzip
    with gzip.open(tmp_path / "centroids_a.csv.gz", "wt") as f:
        f.write("v0,v1\n1.0,0.5\n2.0,\n")
    (tmp_path / "metadata_a.json").write_text(
        '{\n "config": {"umap_neighbors": 5, "hdb_min_cluster_size": 10},\n'
        ' "cluster_names": {"0": "zero"}\n}')
    got = sorted(tuple(r) for r in centroid_files.load_centroids(spark, str(tmp_path)).collect())
    assert got == [("5_10", 0, "zero", [1.0, 0.5]), ("5_10", 1, None, [2.0, 0.0])]
    assert centroid_files.unmatched_configs(spark, str(tmp_path)).count() == 0


def test_centroid_columns_go_by_name(spark, tmp_path):
    import gzip
    for key, n, table in (("a", 5, "cluster_id,v0,v1\n0,1.0,2.0\n"),
                          ("b", 6, "v1,v0,note,cluster_id\n2.0,1.0,text,0\n")):
        with gzip.open(tmp_path / f"centroids_{key}.csv.gz", "wt") as f:
            f.write(table)
        (tmp_path / f"metadata_{key}.json").write_text(
            '{"config": {"umap_neighbors": %d, "hdb_min_cluster_size": 10}, '
            '"cluster_names": {"0": "zero"}}' % n)
    got = sorted(tuple(r) for r in centroid_files.load_centroids(spark, str(tmp_path)).collect())
    assert got == [("5_10", 0, "zero", [1.0, 2.0]), ("6_10", 0, "zero", [1.0, 2.0])]


def test_no_centroids(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        centroid_files.load_centroids(spark, str(tmp_path))


def test_round_trip_through_xml(spark):
    df = spark.createDataFrame([("a <b> & c", None), (None, "x")], "t string, a string")
    xml = records.to_record([(F.col("t"), None)], F.col("a"))
    got = records.extract_record(df.select(F.lit("f").alias("file"), xml.alias("xml")),
                                 "file", "xml").collect()
    assert {(r["title"], r["abstract"]) for r in got} == {("a <b> & c", None), (None, "x")}


def test_large_file_is_read_by_several_tasks(spark, tmp_path):
    """One file of many records: Spark cuts it between records, none is lost or doubled."""
    body = "x" * 4000
    xml = [f"<rdf:RDF><rdf:Description><dc:title>t{k}</dc:title><a>{body}</a></rdf:Description></rdf:RDF>"
           for k in range(2000)]
    (tmp_path / "all.rdf").write_text("\n".join(xml))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        found = records.scan_files(spark, str(tmp_path), record_end=records.RECORD_END)
        parts = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) > 3 and sum(r["count"] for r in parts) == 2000
        got = records.extract_record(found, "file", "xml")
        assert {r.title for r in got.select("title").collect()} == {f"t{k}" for k in range(2000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
