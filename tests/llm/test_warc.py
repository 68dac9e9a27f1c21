"""Archives: round trip, revisit records, and magic strings inside payloads."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import text_cases as T
from skytally.llm import warc
from skytally.session import scratch_dir

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77777>\r\nContent-Length: %d\r\n\r\n"


def _pages():
    r = random.Random(4)
    rows = []
    for i in range(300):
        parts = ["x" * r.randint(0, 300), "WARC/1.0\r\n", FAKE % r.randint(0, 900), FAKE % 3 + "abc\r\n\r\n", "\r\n\r\n", "é日\n", FAKE % 10 ** 12]
        rows.append((i, None if i % 9 == 0 else f"http://a/{i}\r\n", None if i % 17 == 0 else "".join(r.choice(parts) for _ in range(r.randint(0, 8)))))
    rows += [(i + 400, u, h) for i, u, h in rows[:50]] + [(None, "u", rows[3][2]), (None, None, None), (900, "u", "y" * 300_000), (901, "v", "y" * 300_000)]
    return rows + [(902, "w", "tie" * 50), (902, "w", "tie" * 50)]


def _expected(rows):
    ids = defaultdict(list)
    for i, _, h in rows:
        ids[h or ""].append(T.LAST if i is None else i)
    for i, _, h in rows:
        b, first = (h or "").encode(), min(ids[h or ""])
        again = len(b) >= 100 and (T.LAST if i is None else i) > first
        yield i, len(b), T.sha(b), "revisit" if again else "response", first if again else None


@pytest.mark.parametrize("split", ["64m", "3k"])
def test_round_trip_with_magic_inside_payloads(spark, split):
    rows = _pages()
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, payload_digest string, value int").repartition(2)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        T.same(warc.warc_round_trip(pages).collect(), _expected(rows))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_empty_table(spark):
    assert warc.warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archive_is_a_chain_of_records(spark):
    path = scratch_dir(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([(1, "u", "a" * 120), (2, None, "a" * 120)], "page_id long, url string, html string").coalesce(1), path)
    import glob

    raw = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{path.removeprefix('file:')}/part-*")))
    types, at = [], 0
    while at < len(raw):
        assert raw.startswith(warc.MAGIC, at)
        head = raw[at + len(warc.MAGIC):raw.index(warc.END, at)]
        fields = warc.parse(head)
        types.append(fields["warc-type"])
        at = raw.index(warc.END, at) + 4 + int(fields["content-length"])
        assert raw.startswith(warc.END, at)
        at += 4
    assert Counter(types) == {"response": 1, "revisit": 1}


def test_payloads_are_not_shuffled_beside_few_copies(spark, tmp_path):
    """The join with the repeated digests is a broadcast from the start: no exchange of payloads lies below it."""
    path = str(tmp_path / "pages")
    spark.createDataFrame([(k, "u", f"{k % 90}" * 500) for k in range(100)], "page_id long, url string, html string").repartition(3).write.parquet(path)
    pages = spark.read.parquet(path)
    typed = warc.with_types(pages, warc.repeated(pages))
    plan = typed._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert Counter(r.record_type for r in typed.collect()) == {"response": 90, "revisit": 10}
    assert "hashpartitioning" not in typed._jdf.queryExecution().executedPlan().toString()


def test_many_repeated_digests_are_joined_in_slices(spark, monkeypatch):
    rows, jobs = _pages(), []
    made = warc.records
    monkeypatch.setattr(warc, "FEW", 3)
    monkeypatch.setattr(warc, "records", lambda typed: jobs.append(typed) or made(typed))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    T.same(warc.warc_round_trip(pages).collect(), _expected(rows))
    assert len(jobs) == warc.SLICES


def test_only_archives_and_records_stay_on_disk(spark, tmp_path, monkeypatch):
    """Tables that the next one replaces are dropped, whatever the number of splits."""
    monkeypatch.setattr("skytally.llm.shared.scratch_dir", lambda _, label: str(tmp_path / f"{label}-{len(list(tmp_path.iterdir()))}"))
    path = scratch_dir(spark, "warc-test")
    warc.write_warc(spark.createDataFrame([(k, "u", "a" * 120) for k in range(20)], "page_id long, url string, html string").repartition(3), path)
    assert warc.read_warc(spark, path).count() == 20
    left = {x.name.rsplit("-", 1)[0] for x in tmp_path.iterdir()}
    assert "warc-records" in left and not left & {"warc-candidates", "warc-offsets"}


def test_exits_by_pointer_jumping():
    rel, succ = np.array([0, 10, 20, 30, 40]), np.array([10, 40, 25, -1, 100])
    assert warc.exits(rel, succ, 50).tolist() == [100, 100, -1, -1, 100]
