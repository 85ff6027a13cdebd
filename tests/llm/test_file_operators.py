"""URL filter, archives, mixing, license scan, resharding and the pipeline against plain Python."""

import glob
import gzip
import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from lossmetrics.llm import licenses, mixing, queries, resharding, url_filter, warc
from lossmetrics.llm.tables import written


def collect(df, key):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is not None, r[key]))


def plain_rule(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group(0)
        path = re.match(r"[^?#]*", rest[len(host) :]).group(0)
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(p, v) for p, v in url_filter.RULES if (host == p.split("/")[0] or host.endswith("." + p.split("/")[0])) and path.startswith("/" + p.split("/", 1)[1])]
    return host, path, max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_url_filter(spark, awkward):
    urls = [r["url"] for r in collect(spark.read.parquet(f"{awkward}/pages.parquet"), "page_id")]
    got = collect(queries.registry()["op4_url_filter"](spark, awkward), "page_id")
    model = url_filter.train(url_filter.labelled())
    for row, url in zip(got, urls, strict=True):
        host, path, (rule, verdict) = plain_rule(url)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (verdict or ("block" if model.score(host, path) >= url_filter.THRESHOLD else "allow"))
    assert got[7]["verdict"] == "block" and got[2]["verdict"] == "allow"


def test_url_table_names_no_page_of_the_tables(spark):
    hosts = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select(url_filter.split_url("url")[0].alias("host")).distinct().collect()
    table = {name for name, _, _ in url_filter.names()}
    assert not {part for r in hosts for part in r["host"].split(".")} & table


def test_url_model_separates_left_out_names():
    scores = url_filter.left_out()
    unwanted, ordinary = ([s >= url_filter.THRESHOLD for _, label, s in scores if label == k] for k in (1, 0))
    assert sum(unwanted) >= 0.9 * len(unwanted) and sum(ordinary) <= 0.01 * len(ordinary)
    new_words = [s >= url_filter.THRESHOLD for _, label, s in url_filter.left_out(by_word=True) if label == 0]
    assert sum(new_words) <= 0.025 * len(new_words)
    model = url_filter.train(url_filter.labelled())
    for host in ("ththere.example.net", "blog.tionsh.example.com", "m.ththand.example.org", ""):
        assert model.score(host, "/en/51234" if host else "") < url_filter.THRESHOLD


def test_url_model_against_plain_gradient_descent():
    rows = [url_filter.hosted(name, label) for name, _, label in url_filter.names()[::40]]
    x = np.zeros((len(rows), 512))
    for k, (host, path, _) in enumerate(rows):
        grams = [zlib.crc32(m + t[i : i + n]) % 512 for m, t in ((b"h", f"^{host}$".encode()), (b"p", f"^{path}$".encode())) for n in (3, 4, 5) for i in range(len(t) - n + 1)]
        for g in grams:
            x[k, g] += 1 / len(grams) ** 0.5
    y = np.array([r[2] for r in rows])
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    w, b = np.zeros(512), 0.0
    for _ in range(20):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) * share
        w, b = w - 2.0 * (x.T @ error + 0.01 * w), b - 0.2 * error.sum()
    model = url_filter.train(rows, 512, 20, 2.0, 0.01)
    assert np.allclose(model.weights, w) and np.isclose(model.bias, b)


def plain_captures(pages):
    digest = lambda p: hashlib.sha1((p["html"] or "").encode()).hexdigest()
    size = lambda p: len((p["html"] or "").encode())
    head = defaultdict(int)
    for p in pages:
        head[digest(p)] = max(head[digest(p)], p["page_id"])
    out = []
    for p in pages:
        again = size(p) >= 1000 and head[digest(p)] > p["page_id"]
        out.append({"page_id": p["page_id"], "payload_bytes": size(p), "payload_digest": digest(p), "record_type": "revisit" if again else "response", "refers_to": head[digest(p)] if again else None})
    return out


def test_warc_round_trip(spark, awkward):
    pages = collect(spark.read.parquet(f"{awkward}/pages.parquet"), "page_id")
    assert collect(queries.registry()["op5_warc"](spark, awkward), "page_id") == plain_captures(pages)


def test_warc_keeps_payloads_and_repeated_rows(spark):
    rows = [(1, "http://a/", "x" * 1500), (1, "http://a/", "x" * 1500), (2, None, None), (None, "http://b/\r\n", "é\r\n\r\n"), (3, "http://c/", "x" * 1500)]
    path = warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"))
    records = warc.read(spark, path)
    assert records.count() == 15
    got = warc.captures(records).collect()
    assert len(got) == 5
    assert Counter(r["response"]["kind"] for r in got) == {"response": 3, "revisit": 2}
    by_page = {r["metadata"]["page_id"]: r for r in got}
    assert bytes(by_page["3"]["response"]["payload"]) == b"x" * 1500
    assert bytes(by_page[None]["response"]["payload"]).decode() == "é\r\n\r\n"
    assert by_page[None]["request"]["target"] == "http://b/%0D%0A"
    assert by_page["1"]["response"]["refers_to"] == "3"


def test_parse_rejects_a_wrong_digest():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Target-URI: b\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    with pytest.raises(ValueError):
        list(warc.parse([record]))


def test_archives_are_read_in_pieces():
    body = "é\r\n\r\nWARC/1.1\r\n".encode() * 7
    one = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Target-URI: b\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    records = [one % (hashlib.sha1(b).hexdigest().encode(), len(b), b) for b in (body, b"", body * 40)]
    whole = b"".join(records)
    for size in (1, 2, 3, 7, 64, 1000, len(whole)):
        got = list(warc.parse(whole[k : k + size] for k in range(0, len(whole), size)))
        assert [r["payload"] for r in got] == [body, b"", body * 40]
    assert list(warc.parse([])) == [] and list(warc.parse([b"", b""])) == []
    for cut in (10, len(records[0]) - 1, len(whole) - 5):
        with pytest.raises(ValueError):
            list(warc.parse([whole[:cut]]))
    packed = gzip.compress(records[0]) + gzip.compress(records[1] + records[2])
    assert b"".join(warc._inflate(packed)) == whole
    with pytest.raises(ValueError):
        list(warc._inflate(packed[:-20]))


def test_large_archive_in_bounded_pieces():
    """300 MB of pages in one archive: no piece is larger than the bound, and the reader holds one record."""
    page = b"<p>word</p>" * 100_000
    one = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Target-URI: b\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n"
    packed = gzip.compress(one % (hashlib.sha1(page).hexdigest().encode(), len(page), page), 1) * 273
    tracemalloc.start()
    assert sum(r["length"] for r in warc.parse(warc._inflate(packed))) == 273 * len(page) > 300_000_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000


def test_files_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 10_000)
    rows = [(k, f"http://a/{k}", f"{k:05d}" * 1000) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = warc.write(df)
    assert len(glob.glob(f"{path}/*.gz")) >= 20 and warc.read(spark, path).count() == 120


def plain_copies(key, rate, seed=0):
    total, parts = 0, math.ceil(rate / mixing.PART)
    for j in range(1, parts + 1):
        u = int(hashlib.md5(f"{seed}:{key}:{j}".encode()).hexdigest()[:13], 16) / (1 << 52)
        p = c = math.exp(-rate / parts)
        k = 0
        while c <= u and k < mixing.STEPS:
            k += 1
            p *= rate / parts / k
            c += p
            total += 1
    return total


def test_mixing_counts(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet").collect()
    count = Counter(d["source"] or "" for d in docs)
    whole = sum(math.sqrt(c) for c in count.values())
    got = Counter(r["doc_id"] for r in queries.registry()["op6_mixing"](spark, awkward).collect())
    for d in docs:
        own = count[d["source"] or ""]
        assert got[d["doc_id"]] == plain_copies(d["doc_id"], len(docs) * math.sqrt(own) / whole / own)


def test_mixing_large_rates_zero_weights_and_order(spark):
    docs = spark.createDataFrame([(k, "rare" if k < 20 else "common", "t") for k in range(400)] + [(None, "gone", "t")], "doc_id long, source string, copy string")
    weights = spark.createDataFrame([("rare", 9.0), ("common", 1.0), ("gone", 0.0), ("absent", 4.0)], "source string, weight double")
    rates = mixing.rates(docs, weights, total=20000)
    found = {r["source"]: (r["rate"], r["parts"]) for r in rates.collect()}
    assert set(found) == {"rare", "common"} and found["rare"][1] > 1
    rows = mixing.replicate(docs, rates, seed=3).collect()
    assert abs(sum(r["source"] == "rare" for r in rows) / len(rows) - 0.9) < 0.01 and abs(len(rows) - 20000) < 600
    assert Counter(r["doc_id"] for r in rows)[0] == plain_copies(0, found["rare"][0], 3)
    assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows)
    assert [r["doc_id"] for r in rows[:50]] != sorted(r["doc_id"] for r in rows[:50])


def plain_scan(files, threshold=licenses.THRESHOLD):
    cut = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    terms = {w for _, body in licenses.TEMPLATES for w in cut(body)}
    seen = Counter(w for f in files for w in set(cut(f["text"] or "")) & terms)
    idf = lambda w: math.log((len(files) + 1) / ((seen[w] if w in terms else 0) + 1)) + 1
    vector = lambda t: {w: n * idf(w) for w, n in Counter(cut(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own = []
    for f in files:
        best = None
        for line in (f["text"] or "").split("\n"):
            v = vector(line)
            for name, body in licenses.TEMPLATES:
                t = vector(body)
                if v:
                    c = round(sum(x * t.get(w, 0) for w, x in v.items()) / norm(v) / norm(t), 9)
                    if c >= threshold and (best is None or (-c, name) < best):
                        best = (-c, name)
        own.append(best)
    given = {}
    for f, b in sorted(zip(files, own), key=lambda x: x[0]["path"] or ""):
        name = (f["path"] or "").rsplit("/", 1)[-1].rsplit(".", 1)[0].upper()
        if b and name in licenses.LICENSE_FILES:
            given.setdefault(f["path"].rsplit("/", 1)[0] if "/" in f["path"] else "", b[1])
    out = []
    for f, b in zip(files, own):
        if b:
            out.append((b[1], -b[0]))
            continue
        at, found = f["path"].rsplit("/", 1)[0] if f["path"] and "/" in f["path"] else "", None
        while f["path"] is not None and found is None:
            found = given.get(at)
            if at == "":
                break
            at = at.rsplit("/", 1)[0] if "/" in at else ""
        out.append((found, None))
    return out


def test_license_scan(spark, awkward):
    docs = queries.source_tree(spark.read.parquet(f"{awkward}/documents.parquet"))
    files = collect(docs, "doc_id")
    got = collect(queries.registry()["op7_license_scan"](spark, awkward), "doc_id")
    assert [(r["license"], r["cosine"]) for r in got] == [(a, pytest.approx(c) if c else c) for a, c in plain_scan(files)]
    assert {r["license"] for r in got} >= {"MIT", "Apache-2.0"}


def test_license_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("LICENSE", mit), ("a/x.txt", "plain"), ("a/b/COPYING.txt", gpl), ("a/b/c/y.txt", None), ("a/b/z.txt", "text\n" + mit), (None, "plain"), ("top.txt", ""), ("a/x.txt", "plain")]
    df = spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("own"))
    got = Counter((r["path"], r["license"], r["basis"]) for r in licenses.scan(df).collect())
    assert got == Counter({
        ("LICENSE", "MIT", "licence file"): 1, ("a/x.txt", "MIT", "inherited"): 2, ("a/b/COPYING.txt", "GPL-3.0", "licence file"): 1,
        ("a/b/c/y.txt", "GPL-3.0", "inherited"): 1, ("a/b/z.txt", "MIT", "header"): 1, (None, None, None): 1, ("top.txt", "MIT", "inherited"): 1,
    })


GPL_HEADER = """# {0} is free software: you can redistribute it and/or modify
# it under the terms of the GNU {1}General Public License as published by
# the Free Software Foundation, either version {2} of the License, or
# (at your option) any later version.
x = 1"""


def test_license_texts_headers_and_variants(spark):
    full = dict(licenses.texts())
    first = lambda name, n: "\n".join(full[name].splitlines()[:n])
    want = {f"{name}/LICENSE": (body, name) for name, body in full.items()}
    want |= {
        "mit/LICENSE": ("Copyright (c) 2020 Some Body\n\n" + full["MIT"], "MIT"),
        "mit/no/title.py": (None, "MIT"),
        "code/mit.c": ("/*\n * " + full["MIT"].replace("\n", "\n * ") + "*/\nint main() { return 0; }\n" * 30, "MIT"),
        "code/isc.c": ("// " + first("ISC", 3).replace("\n", "\n// ") + "\nint x;", "ISC"),
        "apache/LICENSE": ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/", "Apache-2.0"),
        "code/gpl3.py": (GPL_HEADER.format("This program", "", "3"), "GPL-3.0"),
        "code/gpl2.py": (GPL_HEADER.format("This program", "", "2"), "GPL-2.0"),
        "code/agpl.py": (GPL_HEADER.format("This program", "Affero ", "3"), "AGPL-3.0"),
        "code/lgpl.py": (GPL_HEADER.format("This library", "Lesser ", "2.1"), "LGPL-2.1"),
        "one/a": ("GNU General Public License, version 2", "GPL-2.0"),
        "one/b": ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
        "one/c": ("Licensed under CC BY 3.0.", None),
        "one/d": ("This work is licensed under\nthe GNU General Public\nLicense, version 3.", "GPL-3.0"),
        "one/e": ("a story of the permission to sell copies of the house\nand of the river", None),
    }
    df = spark.createDataFrame([(p, t) for p, (t, _) in want.items()], "path string, text string")
    got = {r["path"]: r["license"] for r in licenses.scan(df).collect()}
    assert got == {p: name for p, (_, name) in want.items()}


def test_resharding_query(spark, awkward, texts):
    got = collect(queries.registry()["op8_resharding"](spark, awkward), "doc_id")
    sizes = defaultdict(int)
    for row, text in zip(got, texts, strict=True):
        data = (text or "").encode()
        assert row["size"] == len(data) + 1 and row["text_crc32"] == zlib.crc32(data)
        assert row["law"] == "bytes" and row["grown_shard"] is None
        sizes[row["shard"]] += row["size"]
    for shard in sizes:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert max(sizes.values()) - sum(sizes.values()) / 8 <= max(r["size"] for r in got)


def test_transfers_move_the_fewest_bytes():
    flow = resharding.transfers({0: 100, 1: 10, 2: 40}, {0: 50, 1: 50, 2: 50})
    assert sum(v for (a, b), v in flow.items() if a != b) == 50
    assert sum(v for (_, b), v in flow.items() if b == 1) == 50
    assert resharding.transfers({}, {0: 0}) == {}
    with pytest.raises(ValueError):
        resharding.transfers({0: 5}, {0: 4})


def test_resharding_moves_blocks_and_leaves_the_rest(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.col("id").cast("int") % 50).alias("text")).repartition(12)
    old = resharding.lay_out(docs, F.when(F.col("doc_id") < 2500, 0).otherwise(F.col("doc_id") % 3))
    new = resharding.reshard(old, 4)
    before = {r["doc_id"]: r["shard"] for r in old.rows().select("doc_id", "shard").collect()}
    rows = new.rows().select("doc_id", "shard", "size").collect()
    assert len(rows) == 4000 and {r["doc_id"] for r in rows} == set(range(4000))
    total = sum(r["size"] for r in rows)
    moved = sum(r["size"] for r in rows if before[r["doc_id"]] != r["shard"])
    held = Counter()
    for r in old.rows().select("shard", "size").collect():
        held[r["shard"]] += r["size"]
    least = sum(max(0, size - total // 4) for size in held.values())
    assert abs(moved - least) <= 500
    retired = {(r["shard"], r["block"]) for r in new.retired.collect()}
    blocks = {(r["shard"], r["block"]) for r in old.rows().select("shard", "block").distinct().collect()}
    assert retired < blocks


@pytest.mark.parametrize("name", ["op4_url_filter", "op5_warc", "op6_mixing", "op7_license_scan", "op8_resharding"])
def test_empty_tables(spark, empty, name):
    assert queries.registry()[name](spark, empty).count() == 0


def test_registered_with_the_entry_point():
    known = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} == {re.match(r"op\d+_", q).group(0) for q in known if q.startswith("op")}
    assert known["pipeline"] is corpus_pipeline.run
    assert set(queries.oracle_sql()) == {"op5_warc", "op6_mixing"}


def test_pipeline_stages(spark, awkward):
    """Every stage against plain Python or its own operator's brute-force test, on all that the one before kept."""
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(written(stage(spark, seen[-1], awkward), "test"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "n-gram Jaccard join", "mixing", "BPE encoding"]
    for frame in seen[:-1]:
        assert frame.columns == docs.columns and frame.schema["kept"].dataType == docs.schema["kept"].dataType
    ids = [[r["doc_id"] for r in f.select("doc_id").collect()] for f in seen]
    scores = {r["doc_id"]: r["predicted"] for r in queries.registry()["op10_quality_classifier"](spark, awkward).collect()}
    assert sorted(ids[1]) == sorted(k for k in ids[0] if scores[k])
    assert set(ids[2]) < set(ids[1])
    from tests.llm.test_text_operators import base_rules, brute_components

    held = {r["doc_id"]: r["text"] for r in seen[2].collect()}
    assert all(not base_rules(t)["base_failed"] for t in held.values())
    order = sorted(held)
    groups = brute_components([held[k] for k in order], 5, 80)
    assert sorted(ids[3]) == sorted({order[g] for _, g in groups})
    count = Counter(r["source"] or "" for r in seen[3].collect())
    whole = sum(math.sqrt(c) for c in count.values())
    copies = Counter(ids[4])
    for r in seen[3].collect():
        own = count[r["source"] or ""]
        assert copies[r["doc_id"]] == plain_copies(r["doc_id"], len(ids[3]) * math.sqrt(own) / whole / own)
    assert sorted(ids[5]) == sorted(ids[4])
    assert all(r["n_tokens"] == len(r["ids"]) for r in seen[5].collect())


def test_pipeline_takes_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
