import base64
import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from adtally.llm import archives as ar, chat, queries


def formatted(spark, rows, schema="conv_id long, turn long, role string, text string", **kw):
    df = spark.createDataFrame(rows, schema)
    done = chat.format_chat(df, **kw).withColumn("f", chat.formatted(F.col("segments")))
    return {r.conv_id: r for r in done.withColumns({"back": chat.read_back(F.col("f")), "loss": chat.loss_text(F.col("segments"))}).collect()}


def test_chat_round_trip_of_control_strings(spark):
    random.seed(3)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "[NEXT]", "[NL]", "\\", "\n", "<", "[", "/", "s>", "é", "", " "]
    rows = [(c, t, random.choice(["user", "assistant", "system", "odd\n[NL]role"]), "".join(random.choices(parts, k=9)))
            for c in range(30) for t in range(random.randint(1, 6))]
    got = formatted(spark, rows)
    for c in range(30):
        mine = [(r, x) for k, _, r, x in rows if k == c]
        assert [tuple(b) for b in got[c].back] == mine
        assert got[c].loss == "".join(x for r, x in mine if r == "assistant")
        assert got[c].n_turns == len(mine)
        assert got[c].n_blocks == sum(i == 0 or mine[i - 1][0] != mine[i][0] for i in range(len(mine)))


def test_chat_nulls_ties_chunks_and_clashing_names(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 2, "assistant", "x")]
    got = formatted(spark, [(*r, 5, 6) for r in rows], "conv_id long, turn long, role string, text string, segments int, _c int")
    assert [tuple(b) for b in got[1].back] == [("", "first"), ("user", ""), ("user", "")] and got[1].n_blocks == 2
    assert got[None].loss == "x"
    many = [(7, t, "user" if t % 3 else "assistant", f"t{t}") for t in range(50)]
    got, small = formatted(spark, many), formatted(spark, many, chunk=4)
    assert got[7].f == small[7].f and got[7].n_blocks == small[7].n_blocks and small[7].n_turns == 50
    assert formatted(spark, []) == {}


def test_chat_has_no_python_on_its_path(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", "hi")], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    plan = queries.QUERIES["op1_chat_formatting"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_pages_through_archives(spark, tmp_path):
    rows = [(5, "http://a/", "same"), (3, "http://b c/", "same"), (4, None, None), (9, "http://d/", ""), (2, "dns:x", "é\r\n\r\nWARC/1.0\r\n" * 3),
            (8, "http://e/", "long " * 4000), (None, "http://f/", "same"), (7, "http://g/", "same"), (7, "http://g/", "same")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int").repartition(3)
    got = ar.pages_through_warc(df, str(tmp_path / "w")).collect()
    assert len(got) == len(rows)
    for r in got:
        body = next((h or "").encode() for p, _, h in rows if p == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(body), sha(body))
    kind = sorted((r.page_id or 99, r.record_type, r.refers_to) for r in got)
    assert kind == [(2, "response", None), (3, "response", None), (4, "response", None), (5, "revisit", 3), (7, "revisit", 3), (7, "revisit", 3),
                    (8, "response", None), (9, "revisit", 4), (99, "revisit", 3)]
    assert ar.pages_through_warc(df.limit(0), str(tmp_path / "none")).count() == 0
    few = {r.page_id: r.record_type for r in ar.pages_through_warc(df.filter("page_id in (4, 9)"), str(tmp_path / "m"), min_bytes=1).collect()}
    assert few == {4: "response", 9: "response"}


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    doc = b"HTTP/1.0 200 OK\r\n\r\nbody\nfiledesc://"
    data = ar.version_block("x.arc", version, "20010203040506")
    data += ar.arc_record("http://a/ b", "20010203040506", "text/html", doc, version, "x.arc", len(data))
    data += b"not a header line\n\n" + ar.arc_record("dns:a", "2001", "text/dns", b"", version, "x.arc", 0)
    data += ar.arc_record("http://cut/", "20010203040506", "text/html", doc, version, "x.arc", 0)[:-9]
    found = list(ar.parse_arc(gzip.compress(data)))
    assert [f[1]["URL"] for f in found] == ["filedesc://x.arc", "http://a/%20b", "dns:a", "http://cut/"]
    assert [f[2] for f in found[1:]] == [doc, b"", doc[:-8]] and [f[3] for f in found] == [False, False, False, True]
    assert ar.warc_date("20010203040506") == "2001-02-03T04:05:06Z" and ar.warc_date("2001") == "2001-01-01T00:00:00Z"
    assert ar.warc_date("x") == ar.warc_date("99999999999999") == "1970-01-01T00:00:00Z"


def test_converted_files_are_warc(spark, tmp_path):
    html = ["<p>a</p>", "<p>a</p>", "b"]
    arcs = ar.archive_pages(spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string").coalesce(1))
    records = ar.convert(arcs).withColumn("page_id", ar.page_id(F.col("head")))
    ar.write_warc(ar.with_revisits(records, records, ["page_id"]), str(tmp_path / "w"))
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "w").glob("part-*"))
    found = list(ar.parse_warc(io.BytesIO(raw)))
    assert sorted(h["warc-type"] for h, _ in found) == ["response", "response", "revisit", "warcinfo"]
    first = next(h for h, b in found if b.endswith(b"<p>a</p>"))
    again = next(h for h, _ in found if h["warc-type"] == "revisit")
    assert again["warc-refers-to"] == first["warc-record-id"] and again["warc-profile"].endswith("identical-payload-digest")
    assert first["warc-block-digest"] == "sha1:" + sha(next(b for h, b in found if h is first))
    assert all(r.intact for r in ar.read_warc(ar.read_archives(spark, str(tmp_path / "w"))).collect())
    with pytest.raises(ValueError):
        list(ar.parse_warc(io.BytesIO(b"junk\r\n")))
