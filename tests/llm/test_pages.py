from __future__ import annotations

import base64
import gzip
import hashlib
import io

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from trip_star.llm import url_filter, warc
from trip_star.llm.common import materialise, scratch_dir


@pytest.fixture(scope="module")
def pages(spark):
    big = "<p>" + "x" * 3_000_000 + "</p>"
    rows = [
        (5, "http://a.com/1", "<html>same</html>", "c"), (3, "http://a.com/2", "<html>same</html>", "c"), (3, "http://a.com/2", "<html>same</html>", "c"),
        (9, None, None, "c"), (8, "http://é.org/\r\nx", "", "c"), (7, "http://b.com", "é \r\n\r\n WARC/1.1 ü", "c"), (None, "http://n.com", "<html>same</html>", "c"),
        (None, None, "only here", "c"), (20, "u", big, "c"), (21, "u", big, "c"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, archive string").repartition(3)


def expected_rows(rows):
    first = {}
    for r in rows:
        key = r["html"] or ""
        order = (r["page_id"] is None, r["page_id"] or 0)
        first[key] = min(first.get(key, order), order)
    out, used = [], set()
    for r in rows:
        payload = (r["html"] or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        head = first[r["html"] or ""]
        response = (r["page_id"] is None, r["page_id"] or 0) == head and (r["html"] or "") not in used
        if response:
            used.add(r["html"] or "")
        out.append((r["page_id"], len(payload), digest, "response" if response else "revisit", None if response or head[0] else head[1]))
    return sorted(out, key=str)


def test_archives_round_trip(pages):
    folder, index = warc.archive_pages(pages)
    out = warc.read_members(index, folder, StructField("page_id", LongType()))
    assert sorted((tuple(r) for r in out.collect()), key=str) == expected_rows(pages.collect())


def test_small_payloads_stay_responses(pages):
    folder, index = warc.archive_pages(pages, min_bytes=100)
    kinds = {(r["payload_bytes"], r["record_type"]) for r in warc.read_members(index, folder, StructField("page_id", LongType())).collect()}
    assert all(kind == "response" for size, kind in kinds if size < 100) and any(kind == "revisit" for _, kind in kinds)


def test_each_record_is_a_member_and_the_sidecar_finds_it(pages):
    folder, index = warc.archive_pages(pages)
    files, path = warc.open_folder(folder)
    for archive in {r["archive"] for r in index.collect()}:
        data = files.open_input_file(f"{path}/{archive}").read()
        lines = files.open_input_file(f"{path}/{archive}.idx").read().decode().splitlines()
        for line in lines:
            offset, length, kind, digest, record_id = line.split("\t")
            record = gzip.decompress(data[int(offset) : int(offset) + int(length)])  # one whole member
            assert record.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode()) and record.endswith(b"\r\n\r\n")
            assert f"sha1:{digest}".encode() in record and record_id.encode() in record
        assert sum(int(x.split("\t")[1]) for x in lines) == len(data)


def test_the_crawl_archives_are_single_streams(spark, pages):
    import zlib

    folder = scratch_dir(spark, "warc-test")
    records = materialise(warc.write_archives(pages, folder), "warc-test")
    files, path = warc.open_folder(folder)
    for archive in {r["archive"] for r in records.collect()}:
        inflate = zlib.decompressobj(31)
        inflate.decompress(files.open_input_file(f"{path}/{archive}").read())
        assert inflate.eof and not inflate.unused_data


def test_reader_takes_archives_of_many_members():
    records = [warc.record("response", f"urn:record:a:{i}:{i}", "u", "D", b"x" * i * 1000) for i in range(5)]
    data = b"".join(gzip.compress(r) for r in records)
    found = list(warc.Records(io.BytesIO(data)))
    assert [warc.row_id_of(h["warc-record-id"]) for h, _ in found] == ["0", "1", "2", "3", "4"]
    with pytest.raises(EOFError):
        list(warc.Records(io.BytesIO(gzip.compress(records[4][:-700]))))


def test_no_pages(spark, pages):
    folder, index = warc.archive_pages(pages.limit(0))
    assert warc.read_members(index, folder, StructField("page_id", LongType())).count() == 0


def test_warc_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    found = warc.query(spark, sf_dir)
    expected = con.sql(warc.SQL).project(", ".join(found.columns)).fetchall()
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(expected, key=str)


# URL filter -----------------------------------------------------------------

URLS = [
    "http://WWW.Example.com/en/1?q=/x", "https://example.com/en/", "https://example.com/en", "http://a.example.com/en/x#y", "http://x.net/es/1",
    "http://net/fr/", "http://anet/fr/1", "ftp://y.com", "http://y.com?x=/", "http://y.com/", "no scheme", "", None, "http:///p", "x://u@z.co.uk:8080/a",
    "http://a.b/c\nd?e",
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    tail = rest[end:]
    return host, tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]


def brute_judge(pages, outcomes, z=1.645, cutoff=0.5):
    """(id, url), {id: [bad]} -> rows, by plain loops."""
    parsed = [(i, *parse(u)) for i, u in pages]
    counts = {}
    for i, host, _ in parsed:
        seen = outcomes.get(i, [])
        n, bad = counts.get(host, (0, 0))
        counts[host] = (n + len(seen), bad + sum(seen))

    def levels(host):
        bare = host.rpartition("@")[2]
        head, _, port = bare.rpartition(":")
        bare = head if head and port.isdigit() or bare.endswith(":") else bare
        labels = bare.split(".")
        k = 2 if len(labels) >= 2 and ".".join(labels[-2:]) in url_filter.TWO_LABEL_SUFFIXES else 1
        return ".".join(labels[-k:]), ".".join(labels[-k - 1 :])

    def shrink(children, prior):
        scatter = sum((b - n * prior[c]) ** 2 - n * prior[c] * (1 - prior[c]) for c, (n, b) in children.items())
        chance = sum(n * (n - 1) * prior[c] * (1 - prior[c]) for c, (n, b) in children.items())
        rho = min(0.999, max(0.001, scatter / chance)) if chance > 0 else 0.001
        s = 1 / rho - 1
        return {c: (s * prior[c] + b, s * (1 - prior[c]) + n - b) for c, (n, b) in children.items()}

    def total(key):
        out = {}
        for host, (n, b) in counts.items():
            k = key(host)
            out[k] = (out.get(k, (0, 0))[0] + n, out.get(k, (0, 0))[1] + b)
        return out

    rate = {k: a / (a + b) for k, (a, b) in {}.items()}
    n_all, bad_all = sum(n for n, _ in counts.values()), sum(b for _, b in counts.values())
    suffix = total(lambda h: levels(h)[0])
    rate = {k: a / (a + b) for k, (a, b) in shrink(suffix, dict.fromkeys(suffix, (bad_all + 1) / (n_all + 2))).items()}
    domain = total(levels)
    rate = {k: a / (a + b) for k, (a, b) in shrink(domain, {k: rate[k[0]] for k in domain}).items()}
    own = shrink(counts, {h: rate[levels(h)] for h in counts})
    out = []
    for i, host, path in parsed:
        fits = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        a, b = own[host]
        bound = a / (a + b) - z * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5
        rule = max(fits)[1] if fits else None
        verdict = max(fits)[2] if fits else "block" if bound > cutoff and n_all else "allow"
        out.append((i, host, path, rule, verdict, round(bound, 9)))
    return sorted(out, key=str)


def judged(df, places=9):
    columns = ("page_id", "host", "path", "rule", "verdict")
    return sorted(((*(r[c] for c in columns), round(r["bad_bound"], places)) for r in df.collect()), key=str)


@pytest.mark.parametrize("hot_rows", [1_000, 3])
def test_urls_against_brute_force(spark, monkeypatch, hot_rows):
    from trip_star.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", hot_rows)
    rows = list(enumerate(URLS))
    rows += [(100 + i, f"http://bad.spam.org/{i}") for i in range(40)] + [(200 + i, f"http://good{i % 3}.fine.org/{i}") for i in range(40)]
    rows += [(300 + i, f"http://h{i}.spam.org/") for i in range(5)] + [(None, "http://bad.spam.org/x")]
    outcomes = {i: [int(i < 200)] for i in range(100, 240)} | {0: [0, 1], 3: [1]}
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(i, b) for i, x in outcomes.items() for b in x] + [(5, None), (999, 1)], "page_id long, bad int")
    out = url_filter.judge(pages, labels)
    expected = brute_judge(rows, outcomes)
    assert judged(out) == expected
    verdicts = {r["host"]: r["verdict"] for r in out.collect()}
    assert verdicts["bad.spam.org"] == "block" and verdicts["good1.fine.org"] == "allow"


def test_no_labels_block_nothing_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    assert [r["verdict"] for r in url_filter.judge(pages, none).collect()] == ["allow"]
    assert url_filter.judge(pages.limit(0), none).count() == 0


def test_url_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()]
    outcomes = {}
    for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect():
        outcomes.setdefault(r["doc_id"], []).append(int(r["toxic"] == 1 or r["quality"] == 0))
    assert judged(url_filter.query(spark, sf_dir), 6) == sorted(((*r[:5], round(r[5], 6) + 0.0) for r in brute_judge(rows, outcomes)), key=str)


def test_columns_of_any_name_pass_or_are_replaced(spark):
    """Every name of a result and every name used inside."""
    result = ["host", "path", "rule", "verdict", "n_labelled", "bad_rate", "bad_bound"]
    inside = [
        "of_host", "of_pages", "page", "ruled", "judged", "judged_host", "n_pages", "n_labelled_all", "n", "bad", "prior", "suffix", "domain",
        "hosts", "domains", "labelled", "strength", "h_a", "h_b",
    ]
    rows = list(enumerate(URLS))
    plain = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(0, 1), (3, 0), (3, 1)], "page_id long, bad int")
    clash = plain.select("*", *[F.concat(F.lit(f"{c} of "), F.col("page_id")).alias(c) for c in result + inside])
    out = url_filter.judge(clash, labels)
    assert judged(out) == judged(url_filter.judge(plain, labels))
    assert out.columns == ["page_id", "url", *inside, *result]
    for r in out.collect():
        assert all(r[c] == f"{c} of {r['page_id']}" for c in inside)


def test_url_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for table in ("pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = url_filter.query(spark, sf_dir)
    expected = con.sql(url_filter.SQL).project(", ".join(found.columns)).fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_folders_are_named_as_hadoop_names_them():
    assert warc.arrow_uri("s3a://bucket/a s3a://b") == "s3://bucket/a s3a://b"
    assert warc.arrow_uri("s3n://bucket/a") == "s3://bucket/a"
    assert warc.arrow_uri("abfss://box@account.dfs.core.windows.net/a") == "abfs://box@account.dfs.core.windows.net/a"
    assert warc.arrow_uri("file:/tmp/a") == warc.arrow_uri("file:///tmp/a") == "file:///tmp/a"
    assert warc.arrow_uri("hdfs://name:8020/a") == "hdfs://name:8020/a"
    with pytest.raises(ValueError, match="wasbs"):
        warc.open_folder("wasbs://box@account.blob.core.windows.net/a")
