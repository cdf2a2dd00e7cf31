import math

from pyspark.sql import functions as F

from probelake.llm import vector_search, warc


def brute_top(rows, k, is_query):
    scaled = {}
    for vec_id, v in rows:
        if vec_id is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        mine = [math.floor(x * 1024) for x in v]
        scaled[vec_id] = min(mine, scaled.get(vec_id, mine))
    out = set()
    for q, v in scaled.items():
        if is_query(q):
            scores = sorted((-sum(map(int.__mul__, v, w)), i) for i, w in scaled.items() if i != q and len(w) == len(v))
            out |= {(q, rank + 1, i, -score) for rank, (score, i) in enumerate(scores[:k])}
    return out


def test_odd_vectors(spark):
    rows = [(i, [math.sin(i * j + 1) / 3 for j in range(8)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # copies: ties go to the smaller id
    rows += [(None, [1.0] * 8), (2001, None), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (2005, [])]
    rows += [(2010, [0.5, 0.25]), (2020, [0.1, -0.9]), rows[3], (2030, [0.0] * 8), (2040, [-1.0, 1.0] * 4), (2050, [1.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, rank string, v int")
    got = vector_search.top_k(frame, F.col("vec_id") % 10 == 0, k=10)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute_top(rows, 10, lambda i: i % 10 == 0)
    assert vector_search.top_k(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_bounds_leave_most_vectors_unread(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = vector_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 4 == 0, k=5)
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 5, lambda i: i % 4 == 0)


def pages(spark):
    html = "<p>" + "words of a page " * 40
    rows = [(i, f"http://h{i % 3}.example/{i}", f"{html}{i}") for i in range(60)]
    rows += [(100 + i, None, "<p>same") for i in range(5)] + [(200, "u: v\nw", None), (201, "", ""), (201, "", ""), (None, "n", "<p>same"), (None, None, "only")]
    rows += [(300, "http://long.example", "é" * 3_000_000), (301, "http://long.example", "é" * 3_000_000)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string")


def expected(rows, least):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        last = max(same, default=None) if len(payload) >= least else None
        revisit = last is not None and last != page_id
        out.append((page_id, len(payload), warc.payload_digest(payload), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rows, frame = pages(spark)
    for least in (0, 10):
        assert sorted((tuple(r) for r in warc.round_trip(frame, least).collect()), key=repr) == expected(rows, least)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_archives_hold_payloads_and_a_dictionary(spark, tmp_path):
    rows, frame = pages(spark)
    files = warc.write_archives(frame.coalesce(1), str(tmp_path / "w"))
    assert sum(r["records"] for r in files.collect()) == len(rows)
    heads = [path.read_bytes()[:4] for path in (tmp_path / "w").glob("*.warc.zst")]
    assert warc.DICTIONARY_FRAME.to_bytes(4, "little") in heads
    (tmp_path / "w" / "left-by-a-lost-task.warc.zst").write_bytes(warc.build_archive([b"junk"] * 3))
    read = warc.read_records(spark, str(tmp_path / "w"), files).where("record_type = 'response'").collect()
    htmls = {(r["page_id"], bytes(r["payload"]).decode()) for r in read}
    assert (59, rows[59][2]) in htmls and (301, "é" * 3_000_000) in htmls and (104, "<p>same") in htmls


def test_frames_stand_alone():
    records = [warc.build_record(i, "u", b"text %d " % i * 30, warc.payload_digest(b"text %d " % i * 30), None, None, False) for i in range(200)]
    data = warc.build_archive(records)
    assert len(data) < sum(map(len, records)) / 2
    assert [fields["Page-Id"] for fields, _ in warc.read_archive(data)] == [str(i) for i in range(200)]
    assert list(warc.read_archive(warc.build_archive([]))) == []
