import gzip

import pytest

from tideline.llm.warc import (
    CorruptRecord,
    archive_pages,
    digest,
    parse_head,
    read_warc,
    record,
    record_key,
    write_warc,
)

PAGES = [
    (1, "u/1", "<a>"),
    (2, "u/2", "<a>"),
    (3, None, None),
    (4, "x\ny: z", ""),
    (None, "n", "<a>"),
    (5, "z", "é\r\n\r\nWARC/1.1\r\n" * 50_000),
    (6, "z", "once"),
    (6, "z", "once"),
]


@pytest.fixture
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.selectExpr("*", "1 as id", "2 as body", "3 as record_type").repartition(3)


@pytest.fixture
def archive(pages, tmp_path):
    path = str(tmp_path / "warc")
    archive_pages(pages, path, roll_bytes="2000")
    return path


def keyed(df):
    return df.withColumn("page_id", record_key("record_id")).withColumn("to", record_key("refers_to"))


def test_round_trip(spark, archive):
    rows = keyed(read_warc(spark, archive)).collect()
    found = sorted(
        ((r.page_id, r.payload_length, r.payload_digest, r.record_type, r.to) for r in rows), key=repr
    )
    expected = []
    first = {}
    for i, _, html in PAGES:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    for i, _, html in PAGES:
        raw = (html or "").encode()
        kind = "response" if first[html or ""] == i else "revisit"
        to = first[html or ""] if kind == "revisit" else None
        expected.append((i, len(raw), digest(raw), kind, to))
    assert found == sorted(expected, key=repr)
    for r in rows:
        if r.record_type == "response":
            assert r.payload.decode() == next(h or "" for i, _, h in PAGES if i == r.page_id)
        else:
            assert r.payload is None


def test_small_payloads_are_no_revisits(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    archive_pages(pages, path, min_revisit_bytes=4)
    kinds = {r.page_id: r.record_type for r in keyed(read_warc(spark, path)).collect()}
    assert set(kinds.values()) == {"response"}


def test_predicates_reach_the_reader(spark, archive):
    df = read_warc(spark, archive)
    one = df.filter("record_type = 'revisit' AND target_uri LIKE 'u/%'")
    assert [r.target_uri for r in one.collect()] == ["u/2"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "revisit" not in plan and "StartsWith" not in plan
    some = df.filter(df.record_id.isin("<urn:x-record:1>", "<urn:x-record:6>"))
    assert some.count() == 3
    assert df.filter(f"payload_digest = '{digest(b'<a>')}'").count() == 3
    # What the reader doesn't take stays in Spark.
    assert df.filter("payload_length > 10").count() == 1


def test_payloads_are_left_alone(spark, archive, monkeypatch):
    import tideline.llm.warc as module

    rows = read_warc(spark, archive, payload=False).collect()
    assert all(r.payload is None for r in rows) and len(rows) == len(PAGES)
    assert {r.payload_length for r in rows} == {len((h or "").encode()) for _, _, h in PAGES}
    # Bytes inflated for a record that a predicate refuses: the head's first piece only.
    asked = []
    real = module.Member.upto

    def upto(self, n):
        raw = real(self, n)
        asked.append(len(raw))
        return raw

    monkeypatch.setattr(module.Member, "upto", upto)
    import pyarrow.fs as fs

    local, root = fs.FileSystem.from_uri(archive)
    for info in local.get_file_info(fs.FileSelector(root)):
        if info.path.endswith(".gz"):
            with local.open_input_file(info.path) as file:
                assert list(module.read_records(file, lambda h: False, True)) == []
    assert len(asked) == len(PAGES) and max(asked) <= module.HEAD_BYTES + 1


def test_other_gzip_readers_see_the_records(archive, tmp_path):
    raw = b"".join(gzip.open(p).read() for p in (tmp_path / "warc").iterdir() if p.suffix == ".gz")
    assert raw.count(b"WARC-Record-ID") == len(PAGES)
    assert parse_head(raw).headers["content-type"] == "application/http; msgtype=response"


def test_archives_from_elsewhere(spark, tmp_path):
    """Plain files and gzip members without lengths, in folders without a manifest."""
    folder = tmp_path / "foreign"
    (folder / "deep").mkdir(parents=True)
    day = "2024-01-01T00:00:00Z"
    records = [record("response", f"<r{i}>", f"u{i}", None, b"x" * i, day) for i in range(3)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <i>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (folder / "a.warc").write_bytes(info + b"".join(records))
    (folder / "deep" / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (folder / "notes.txt").write_text("no archive")
    rows = read_warc(spark, str(folder)).collect()
    assert sorted(r.record_id for r in rows) == sorted(["<i>"] + [f"<r{i}>" for i in range(3)] * 2)
    assert next(r.payload for r in rows if r.record_type == "warcinfo") == b"hello"
    light = read_warc(spark, str(folder), payload=False).filter("record_type = 'response'")
    assert sorted(r.payload_length for r in light.collect()) == [0, 0, 1, 1, 2, 2]
    assert read_warc(spark, str(folder / "a.warc")).count() == 4


@pytest.mark.parametrize("damage", ["cut", "digest"])
def test_damage_is_an_error(spark, tmp_path, damage):
    raw = record("response", "<r>", "u", None, b"payload", "d")
    raw = raw[:-20] if damage == "cut" else raw.replace(b"payload\r\n", b"pavload\r\n")
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(raw)[: -30 if damage == "cut" else None])
    with pytest.raises(Exception, match="CorruptRecord|cut short|digest"):
        read_warc(spark, str(tmp_path / "x.warc.gz")).collect()


def test_appending_and_empty_tables(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    archive_pages(pages.filter("false"), path)
    assert read_warc(spark, path).count() == 0
    archive_pages(pages, path)
    archive_pages(pages, path)
    assert read_warc(spark, path).count() == 2 * len(PAGES)


def test_columns_to_write(spark, tmp_path):
    with pytest.raises(Exception, match="record_id|UNRESOLVED"):
        write_warc(spark.range(1), str(tmp_path / "w"))


def test_head_without_a_start():
    with pytest.raises(CorruptRecord):
        parse_head(b"HTTP/1.1 200 OK\r\n\r\n")
    assert parse_head(b"WARC/1.1\r\nA: b") is None
