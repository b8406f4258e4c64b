"""Dictionaries of archives with few and large pages."""

import io
import random

import pytest

from trajspark.llm import op2_warc as op
from trajspark.llm.common import new_path


def page(rng, size):
    words = [f"<p class='{w}'>{w}</p>" for w in "alpha beta gamma delta epsilon zeta eta theta".split()]
    out = []
    while sum(map(len, out)) < size:
        out.append(rng.choice(words) + f"{rng.getrandbits(32):x}")
    return "".join(out).encode()


@pytest.mark.parametrize("count,size", [(100, 160_000), (1, 300_000), (4, 9_000), (7, 2_000)])
def test_large_pages_have_a_dictionary(tmp_path, count, size):
    rng = random.Random(count)
    one = page(rng, size)
    records = [op._record(i, f"http://h/{i}", one[i:] + one[:i], size, "00" * 20, None) for i in range(count)]
    name, n, _ = op._write_archive(str(tmp_path), records)
    raw = (tmp_path / name).read_bytes()
    assert raw[:4] == op.DICT_FRAME.to_bytes(4, "little") and n == count
    blocks = [block for _, block in op.records_of(io.BytesIO(raw))]
    assert len(blocks) == count and all(r.endswith(b + b"\r\n\r\n") for r, b in zip(records, blocks, strict=True))
    assert sum(map(len, op._samples(records))) <= op.SAMPLE_BYTES


def test_small_payload_that_many_pages_share(spark):
    rows = [(i, f"http://h/{i}", None if i % 2 else "<p>not found") for i in range(4000)]
    rows += [(4000 + i, "u", f"{i % 3}" * 2000) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        folder = new_path(spark, "warc")
        manifest = op.write_archives(pages, folder)
        records = [r["records"] for r in manifest.collect()]
        kinds = [r["record_type"] for r in op.read_archives(manifest, folder).select("record_type").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(records) == len(rows) and max(records) < 1500
    assert kinds.count("revisit") == 3
