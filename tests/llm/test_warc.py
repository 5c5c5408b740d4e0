"""Archives: exact round trips, members and offsets."""

import gzip
import hashlib
import io

import pytest

from lexforge.llm import warc
from lexforge.operators.materialize import work_path

HTML = ["<p>é</p>" * 50, "x" * 99, "y" * 100, "", None, "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 5, "z\n" * 400_000]


def rows():
    made = [(i, f"http://a/{i}", HTML[i % len(HTML)]) for i in range(70)]
    return [*made, (None, None, HTML[0]), (3, "http://b\r\nX: y", HTML[2]), (200, "u", "only" * 100), (None, "n", "null" * 100), (None, "n", "null" * 100)]


def expected(given):
    least = {}
    for key, _, html in given:
        if html and len(html.encode()) >= 100 and key is not None:
            least[html] = min(least.get(html, key), key)
    out = []
    for key, _, html in given:
        raw = (html or "").encode()
        first = least.get(html) if len(raw) >= 100 else None
        other = first is not None and first != key
        out.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if other else "response", first if other else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    given = rows()
    df = spark.createDataFrame([(a, b, c, "q") for a, b, c in given], "page_id long, url string, html string, _digest string").repartition(4)
    found = warc.archive(df).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(given)
    texts = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in given}
    assert all(r.payload == (texts[r.payload_digest] if r.record_type == "response" else None) for r in found)
    assert "http://b%0D%0AX: y" in {r.url for r in found}


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_members_and_index(spark):
    given = rows()[:30]
    pages = spark.createDataFrame(given, "page_id long, url string, html string").repartition(2)
    whole, single = work_path(spark, "archives"), work_path(spark, "records")
    warc.write_archives(warc.with_record_types(pages, "page_id", "url", "html"), whole)
    index = warc.normalise(spark, whole, single).collect()
    assert len(index) == 30
    folder, base = warc.open_folder(single)
    files = {r.file for r in index}
    for name in files:
        raw = folder.open_input_file(f"{base}/{name}").read()
        listed = sorted((r.offset, r.length) for r in index if r.file == name)
        assert [a + n for a, n in listed] == [a for a, _ in listed[1:]] + [len(raw)]  # members follow without a gap
        assert gzip.decompress(raw) == b"".join(gzip.decompress(raw[a:a + n]) for a, n in listed)
        side = folder.open_input_file(f"{base}/{name}.idx").read().decode().splitlines()
        assert [tuple(map(int, line.split("\t")[:2])) for line in side] == listed


def records(n=5):
    return [b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (
        hashlib.sha256(b"p" * (7 * i)).hexdigest().encode(), 7 * i, b"p" * (7 * i)) for i in range(n)]


@pytest.mark.parametrize("chunk", [1, 3, 64, 1 << 20])
@pytest.mark.parametrize("members", [False, True])
def test_normaliser_reads_any_chunks(chunk, members):
    made = records()
    raw = b"".join(map(gzip.compress, made)) if members else gzip.compress(b"".join(made))
    out = io.BytesIO()
    index = list(warc.rewrite(warc.inflated(io.BytesIO(raw), chunk), out))
    assert [gzip.decompress(out.getvalue()[r.offset:r.offset + r.length]) for r in index] == made
    assert [warc.parse_member(out.getvalue()[r.offset:r.offset + r.length]).payload_bytes for r in index] == [7 * i for i in range(5)]


def test_normaliser_refuses_broken_archives():
    raw = gzip.compress(b"".join(records()))
    for broken in (raw[:-20], gzip.compress(b"".join(records())[:-9]), gzip.compress(b"no archive\r\n\r\n")):
        with pytest.raises((ValueError, KeyError)):
            list(warc.rewrite(warc.inflated(io.BytesIO(broken)), io.BytesIO()))
