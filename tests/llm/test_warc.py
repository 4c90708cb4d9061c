"""WARC bundles: an exact round trip, and records against a plain version."""

import random
from pathlib import Path

import pyarrow.fs as fs
import zstandard

from silvermill.llm.warc import (
    fetch_records, header_text, parse_record, payload_digest, read_bundles, read_seek_table, write_bundles,
)
from tests.llm.brute import warc

SCHEMA = "page_id long, url string, html string"


def pages(n=60, seed=3):
    draw = random.Random(seed)
    bodies = [None, "", "a", "naïve – 漢字 \U0001f600", "\r\n\r\nContent-Length: 7\r\n\r\n", "x" * 5000]
    bodies += ["".join(draw.choices("abc \r\n", k=draw.randrange(300))) for _ in range(20)]
    ids = draw.sample(range(1000), n)
    return [(i, f"https://h.example/{i}", draw.choice(bodies)) for i in ids]


def run(spark, rows, folder, **options):
    index = write_bundles(spark.createDataFrame(rows, SCHEMA), str(folder), id_col="page_id", **options)
    return index, read_bundles(index, str(folder))


def number(name):
    return None if name is None else int(name.rsplit(":", 1)[1])


def test_records_against_brute_force(spark, tmp_path):
    rows = pages()
    _, found = run(spark, rows, tmp_path / "w", frame_bytes=2000, bundle_bytes=3000)
    got = [
        (number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to))
        for r in found.collect()
    ]
    assert sorted(got) == sorted(warc([(i, html) for i, _, html in rows]))


def test_payloads_and_addresses_come_back(spark, tmp_path):
    rows = pages()
    _, found = run(spark, rows, tmp_path / "w", frame_bytes=2000)
    wanted = {i: (url, (html or "").encode()) for i, url, html in rows}
    for r in found.collect():
        url, body = wanted[number(r.record_id)]
        assert r.target_uri == url and r.payload_digest == payload_digest(body)
        assert (r.payload == body) if r.record_type == "response" else r.payload is None


def test_index_and_seek_table_lead_to_each_record(spark, tmp_path):
    index, _ = run(spark, pages(), tmp_path / "w", frame_bytes=2000, bundle_bytes=3000)
    found = index.collect()
    assert len({(r.bundle, r.frame) for r in found}) > 5
    for r in found:
        with fs.LocalFileSystem().open_input_file(str(tmp_path / "w" / r.bundle)) as file:
            start, packed, plain = read_seek_table(file)[r.frame]
            data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=plain)
        assert len(data) == plain and parse_record(data[r.offset : r.offset + r.length])[0] == r.record_id


def test_a_plain_decoder_reads_a_whole_bundle(spark, tmp_path):
    index, _ = run(spark, pages(), tmp_path / "w", frame_bytes=2000)
    for name in {r.bundle for r in index.collect()}:
        raw = Path(tmp_path / "w" / name).read_bytes()
        data = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        assert data.count(b"WARC/1.1\r\n") == index.where(index.bundle == name).count()


def test_fetch_reads_only_what_is_wanted(spark, tmp_path):
    rows = pages()
    index, _ = run(spark, rows, tmp_path / "w", frame_bytes=2000)
    some = [f"urn:page:{i}" for i, _, _ in rows[:7]]
    wanted = spark.createDataFrame([(x,) for x in [*some, some[0], "urn:page:none", None]], "record_id string")
    assert sorted(r.record_id for r in fetch_records(index, str(tmp_path / "w"), wanted).collect()) == sorted(some)


def test_short_payloads_are_all_responses(spark, tmp_path):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcd"), (4, "u", "abcd")]
    _, found = run(spark, rows, tmp_path / "w", min_payload=4)
    kinds = {number(r.record_id): r.record_type for r in found.collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_nulls_repeated_rows_and_odd_addresses(spark, tmp_path):
    rows = [(1, None, "abc"), (1, None, "abc"), (2, "a\r\nb: c\td", None), (None, "u", "abc")]
    _, found = run(spark, rows, tmp_path / "w")
    got = found.collect()
    assert sorted((r.record_id, r.record_type) for r in got) == [
        ("urn:page:", "revisit"), ("urn:page:1", "response"), ("urn:page:1", "response"), ("urn:page:2", "response"),
    ]
    assert {r.target_uri for r in got if r.record_id == "urn:page:2"} == {"a%0D%0Ab: c%09d"}
    assert header_text("plain") == "plain"


def test_empty_table_and_clashing_columns(spark, tmp_path):
    index, found = run(spark, [], tmp_path / "none")
    assert index.count() == 0 and found.count() == 0
    frame = spark.createDataFrame(
        [(1, "u", "abc", "k", 2), (2, "u", "abc", "l", 3)],
        "page_id long, url string, html string, payload string, refers_to int",
    )
    index = write_bundles(frame, str(tmp_path / "c"), id_col="page_id")
    assert sorted(r.record_type for r in read_bundles(index, str(tmp_path / "c")).collect()) == ["response", "revisit"]


def test_a_very_long_payload_has_a_frame_of_its_own(spark, tmp_path):
    _, found = run(spark, [(1, "u", "é" * 700_000), (2, "u", "s")], tmp_path / "w", frame_bytes=1000)
    assert {number(r.record_id): r.payload_bytes for r in found.collect()} == {1: 1_400_000, 2: 1}
